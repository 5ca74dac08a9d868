"""End-to-end jobs on small fixtures written to disk (FIXTURES.md edge rows)."""

import json
import os
from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from quarry.operators import quality as Q
from quarry.plans import bike, books, retail, sales
from quarry.sources import preamble as PR
from quarry.streaming import snapshot_ingest as ST


def _station(sid, ts, free, empty, extra=True, lat=40.7, uid="123"):
    st = {"id": sid, "name": f"st{sid}", "latitude": lat, "longitude": -74.0, "timestamp": ts,
          "free_bikes": free, "empty_slots": empty}
    if extra:
        st["extra"] = {"uid": uid, "ebikes": 1, "has_ebikes": True, "last_updated": 1700000000,
                       "renting": 1, "returning": 0}
    return st


def _doc(stations):
    return {"network": {"id": "citi-bike-nyc", "name": "Citi Bike", "href": "http://x", "company": ["Lyft"],
                        "location": {"city": "New York, NY", "country": "US", "latitude": 40.7,
                                     "longitude": -74.0},
                        "stations": stations}}


def _write_docs(folder, name, docs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")


def test_bike_silver_edge_rows(spark, tmp_dir):
    stations = [
        _station("a", "2024-05-01T10:00:00Z", 3, 0),
        _station("b", "", 3, 0),
        _station("c", "garbage", 3, 0),
        _station("d", "1999-12-31T23:00:00Z", 3, 0),
        _station("e", "2024-05-01T10:00:00", None, 2, extra=False),
        _station(None, "2024-05-01T10:00:00Z", 0, 1, lat=41.5, uid="not-a-uid"),
    ]
    _write_docs(tmp_dir, "station_status_2024-05-01_10-00-00.json", [_doc(stations)])
    docs = spark.read.schema(bike.SNAPSHOT_SCHEMA).json(tmp_dir)
    assert docs.agg(F.size(F.first("network.stations"))).first()[0] == 6
    Q.assert_valid(docs, bike.document_rules())
    flat = bike.flatten_stations(docs)
    st_rows = docs.select(F.explode("network.stations").alias("st"))
    bad = {r["rule"]: r["violations"] for r in Q.violation_counts(st_rows, bike.station_rules()).collect()}
    assert bad["station.id"] == 1 and bad["station.latitude"] == 1 and bad["extra.uid"] == 1
    assert bad["station.free_bikes"] == 1  # the missing count
    silver = bike.type_silver(flat, datetime(2024, 5, 1, 10, 5))
    got = {r["station_id"]: r for r in silver.collect()}
    assert set(got) == {"a", "e", None}  # blank, unparsable and pre-2000 timestamps dropped
    assert got["e"]["free_bikes"] == 0 and got["e"]["renting"] is False  # H-7 default, missing extra
    assert got["a"]["renting"] is True and got["a"]["returning"] is False


def test_bike_gold_threshold_is_strict(spark):
    base = [("s", "n", f"2024-05-0{d} 10:00:00", 0 if d <= 4 else 2, 1) for d in range(1, 6)]
    df = spark.createDataFrame(base, "station_id string, network_id string, timestamp string, "
                                     "free_bikes long, empty_slots long") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    out = bike.gold_weekly(df, days=None).collect()
    assert len(out) == 1 and out[0]["is_frequently_empty"] is False  # 4/5 = 0.8 is not > 0.8
    assert str(out[0]["week_start"]) == "2024-04-29"


def test_streaming_ingest_replay_and_rerun(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    _write_docs(landing, "station_status_2024-05-01_10-00-00.json",
                [_doc([_station("a", "2024-05-01T10:00:00Z", 3, 1), _station("b", "2024-05-01T10:00:00Z", 1, 1)])])
    kw = dict(checkpoint=os.path.join(tmp_dir, "ckpt"), multi_line=False,
              table_location=os.path.join(tmp_dir, "master"))
    ST.start(spark, landing, "st_master", **kw).awaitTermination()
    _write_docs(landing, "station_status_2024-05-01_11-00-00.json",
                [_doc([_station("a", "2024-05-01T10:00:00Z", 9, 1)])])
    # an older snapshot landing late must not roll the row back
    _write_docs(landing, "station_status_2024-05-01_09-00-00.json",
                [_doc([_station("a", "2024-05-01T10:00:00Z", 0, 1)])])
    ST.start(spark, landing, "st_master", **kw).awaitTermination()
    got = rows(spark.table("st_master"), "station_id", "free_bikes")
    assert got == [("a", 9), ("b", 1)]
    q = ST.start(spark, landing, "st_master", **kw)
    q.awaitTermination()
    assert rows(spark.table("st_master"), "station_id", "free_bikes") == got


BOOK_FILES = {
    "index-2021-2022.csv": "Banned list,,\nSource: PEN America,,\n\nAuthor,Title,Type of Ban,State,District,Date of Challenge/Removal\n"
                         "\"King, Stephen\",Carrie,Banned from Libraries,Texas,D1,July 2021\n"
                         ",Orphan,banned,Texas,D2,March 2022\n"
                         "PEN America,Note,,,,\n\n",
    "index-2023.csv": "Title,Author,Ban Status,State,District,Year,Origin of Challenge\n"
                    "Carrie,Stephen King,banned,Florida,D3,2023.0,Administrator\n"
                    "Orphan,,banned by restriction,Florida,D4,2023,Formal Challenge\n",
    "index-2023-2024.csv": "Intro text\nTitle,Author,Ban Status,State,District,Year\n"
                         "Carrie,Stephen King,Banned Pending Investigation,Utah,D5,2023-2024\n"
                         "New Book,Someone,banned,Utah,D6,2024\n",
}


def _write_books(folder):
    os.makedirs(folder, exist_ok=True)
    paths = []
    for name, text in BOOK_FILES.items():
        p = os.path.join(folder, name)
        with open(p, "w") as f:
            f.write(text)
        paths.append(p)
    return paths


def test_header_discovery_on_files(spark, tmp_dir):
    paths = _write_books(tmp_dir)
    kept = PR.strip_preamble(PR.lines_from_files(spark, paths))
    heads = {os.path.basename(r["file"]): r["line"] for r in kept.filter("is_header").collect()}
    assert heads["index-2021-2022.csv"].startswith("Author,Title")
    assert heads["index-2023-2024.csv"].startswith("Title,Author")
    assert kept.filter(F.col("line").contains("Banned list")).count() == 0
    assert kept.filter(F.trim("line") == "").count() == 0


def test_books_pipeline(spark, tmp_dir):
    paths = _write_books(os.path.join(tmp_dir, "in"))
    frames = [books.clean_index(f) for f in books.read_indexes(spark, paths)]
    first = {r["Title"]: r for r in frames[0].collect()}
    assert set(first) == {"Carrie", "Orphan"}  # PEN America row dropped
    assert first["Carrie"]["Author"] == "Stephen King" and first["Carrie"]["Year"] == "2021"
    assert "Ban Status" in frames[0].columns and "Type of Ban" not in frames[0].columns
    merged = books.merge(frames, skew_rows=1)
    got = {(r["Title"], r["Author"]): r for r in merged.collect()}
    assert set(got) == {("Carrie", "Stephen King"), ("Orphan", None), ("New Book", "Someone")}
    carrie = got[("Carrie", "Stephen King")]
    assert carrie["Ban Status"] == books.LIBRARY_CLASSROOM_BAN and carrie["State"] == "Texas"
    assert carrie["Year"] == "2021" and carrie["Origin of Challenge"] == "Administration"
    assert got[("New Book", "Someone")]["Year"] == "2024"
    dim = {r["status"]: r["description"] for r in books.ban_status_dimension(merged).collect()}
    assert dim["banned"] == books.BAN_STATUS_DESCRIPTIONS["banned"]
    fact = books.fact_table(merged)
    report = {r["check"]: r["violations"] for r in books.constraint_report(fact, books.ban_status_dimension(merged)).collect()
              if r["check"] in ("primary_key", "foreign_key")}
    assert report == {"primary_key": 0, "foreign_key": 0}
    dash = books.dashboard(merged)
    assert dash["headline"].first()["titles"] == 3
    assert dash["top_banned_titles"].count() >= 1
    assert "Total Count" in dash["by_state_map"].columns


def test_retail_and_sales(spark, tmp_dir):
    raw = spark.createDataFrame([("A", 10.0, 1, 5, 100.0, True), ("A", 20.0, 0, 7, 50.0, False),
                                 ("B", 5.0, 0, 1, 10.0, False), (None, 1.0, 1, 1, 1.0, True)],
                                "Category string, discountPercent double, outOfStock_i int, availableQuantity int, "
                                "mrp double, outOfStock boolean").drop("outOfStock_i")
    rep = retail.reports(retail.clean(raw))
    assert rows(rep["out_of_stock_pct"]) == [("A", 50.0), ("B", 0.0)]
    assert rows(rep["out_of_stock"]) == [("A", 1)]
    p = os.path.join(tmp_dir, "sales.csv")
    with open(p, "w") as f:
        f.write("date,product,quantity,price\n2024-01-01,Widget A,10,5.99\n2024-01-01,Widget B,5,12.49\n"
                "2024-01-02,Widget C,7,9.99\n2024-01-03,,1,1.0\n")
    out = sales.run(spark, p, "sales_t")
    assert out.count() == 3
    assert abs(out.filter("product = 'Widget A'").first()["total"] - 59.9) < 1e-9


def test_bike_run_end_to_end(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    _write_docs(raw, "station_status_2024-05-06_10-00-00.json",
                [_doc([_station("a", "2024-05-06T10:00:00Z", 0, 5), _station("b", "2024-05-06T10:00:00Z", 4, 0)])])
    spark.sql(f"CREATE TABLE bike_master ({', '.join(f'{n} {t}' for n, t in bike.MASTER_FIELDS)}, ts_date date) "
              f"USING parquet PARTITIONED BY (ts_date) LOCATION '{tmp_dir}/master'")
    gold = bike.run(spark, raw, "bike_master", "bike_gold", datetime(2024, 5, 6, 10, 5), as_of="2024-05-08")
    assert rows(gold, "station_id", "is_frequently_empty", "is_frequently_full") == [("a", True, False),
                                                                                   ("b", False, True)]
    # a newer snapshot of the same (station, timestamp) updates the six mutable columns only
    # the newest landed file only (S3); an older file in the folder is ignored
    _write_docs(raw, "station_status_2024-05-06_11-00-00.json",
                [_doc([_station("a", "2024-05-06T10:00:00Z", 7, 1, lat=40.8)])])
    silver = os.path.join(tmp_dir, "silver")
    gold = bike.run(spark, raw, "bike_master", "bike_gold", datetime(2024, 5, 6, 11, 5), as_of="2024-05-08",
                    latest_only=True, silver_dir=silver)
    assert spark.read.parquet(os.path.join(silver, "latest")).count() == 1
    assert spark.read.parquet(os.path.join(silver, "history")).select("run_ts").distinct().count() == 1
    master = {r["station_id"]: r for r in spark.table("bike_master").collect()}
    assert master["a"]["free_bikes"] == 7 and master["a"]["latitude"] == 40.7
    assert rows(gold, "station_id", "avg_free_bikes") == [("a", 7.0), ("b", 4.0)]


def test_books_run_end_to_end(spark, tmp_dir):
    paths = _write_books(os.path.join(tmp_dir, "in"))
    dash = books.run(spark, paths, os.path.join(tmp_dir, "banned_books_csv"), "ban_status_t", "banned_books_t")
    fact = spark.table("banned_books_t")
    assert fact.count() == 3 and fact.filter("title IS NULL").count() == 0
    assert {r["status"] for r in spark.table("ban_status_t").collect()} == {
        books.LIBRARY_CLASSROOM_BAN, "banned"}
    assert dash["top_state"].count() == 1


def test_uid_forms_and_blank_year(spark, tmp_dir):
    stations = [_station("a", "2024-05-01T10:00:00Z", 1, 1, uid="0123456789abcdef0123456789abcdef-123"),
                _station("b", "2024-05-01T10:00:00Z", 1, 1, uid="66"),
                _station("c", "2024-05-01T10:00:00Z", 1, 1, uid="short-hex-abc")]
    _write_docs(tmp_dir, "station_status_2024-05-01_10-00-00.json", [_doc(stations)])
    docs = spark.read.schema(bike.SNAPSHOT_SCHEMA).json(tmp_dir)
    st_rows = docs.select(F.explode("network.stations").alias("st"))
    tagged = Q.with_violations(st_rows, bike.station_rules()).select("st.id", "violations").collect()
    assert {r["id"]: r["violations"] for r in tagged} == {"a": [], "b": [], "c": ["extra.uid"]}
    idx = spark.createDataFrame([("t", "a", "  "), ("u", "b", None), ("v", "c", "May 2022")],
                                "Title string, Author string, `Date of Challenge/Removal` string")
    years = {r["Title"]: r["Year"] for r in books.clean_index(idx).collect()}
    assert years == {"t": None, "u": None, "v": "2022"}


def test_null_country_is_kept_but_null_code_dropped(spark):
    from quarry.plans import covid
    df = spark.createDataFrame([(None, "XXX"), ("World", "AGG"), ("Chile", None), ("Peru", "PER")],
                               "country string, code string")
    assert rows(covid.clean(df)) == [("Peru", "PER"), (None, "XXX")]


def test_header_discovery_across_file_splits(spark, tmp_dir):
    """A big file read as many splits: positions stay ordered within the file, so
    the first header line wins and only lines above it are dropped."""
    p = os.path.join(tmp_dir, "big.csv")
    body = [f"Title {i},Author {i}" for i in range(3000)]
    with open(p, "w") as f:
        f.write("preamble line\nmore preamble\n\nTitle,Author\n" + "\n".join(body[:1500])
                + "\n\nTitle,Author\n" + "\n".join(body[1500:]) + "\n")
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = PR.lines_from_files(spark, p)
        assert lines.rdd.getNumPartitions() > 5
        kept = PR.strip_preamble(lines, ("Title,Author",))
        assert kept.filter("is_header").count() == 1
        assert kept.count() == 1 + 3000 + 1  # first header, all rows, the repeated header line
        assert kept.filter(F.col("line").startswith("preamble")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)


def test_bike_run_rejects_or_quarantines_bad_documents(spark, tmp_dir):
    import pytest as _pytest

    good = _doc([_station("g", "2024-05-06T10:00:00Z", 1, 1)])
    bad = _doc([_station("x", "2024-05-06T10:00:00Z", 1, 1)])
    bad["network"]["id"] = "some-other-network"
    raw = os.path.join(tmp_dir, "raw")
    _write_docs(raw, "station_status_2024-05-06_10-00-00.json", [good, bad])
    spark.sql(f"CREATE TABLE bike_master_q ({', '.join(f'{n} {t}' for n, t in bike.MASTER_FIELDS)}, ts_date date) "
              f"USING parquet PARTITIONED BY (ts_date) LOCATION '{tmp_dir}/master'")
    args = (spark, raw, "bike_master_q", "bike_gold_q", datetime(2024, 5, 6, 10, 5))
    with _pytest.raises(ValueError, match="network.id"):
        bike.run(*args, as_of="2024-05-08")
    bike.run(*args, as_of="2024-05-08", quarantine=True)
    assert rows(spark.table("bike_master_q"), "station_id") == [("g",)]


def test_download_plan(spark):
    pages = spark.createDataFrame([
        (1, "https://example.org/book-bans/banned-book-list-2021-2022",
         '<a href="https://docs.google.com/spreadsheets/d/X/edit?usp=sharing&amp;ouid=1">Download the index</a>'),
        (2, "https://example.org/book-bans/2023-banned-book-list",
         '<p>Download the index</p><a href="https://docs.google.com/spreadsheets/d/Y/export?format=csv">'
         'Download the index</a>'),
        (3, "https://example.org/book-bans/index-of-school-book-bans-2023-2024", "<p>no link</p>"),
    ], "page_id long, url string, html string")
    plan = {r["page_id"]: r for r in books.download_plan(pages).collect()}
    assert set(plan) == {1, 2}
    assert plan[1]["href"].endswith("edit?usp=sharing&ouid=1")  # entity decoded like a parser
    assert plan[1]["export_url"] == "https://docs.google.com/spreadsheets/d/X/export?format=csv"
    assert plan[2]["export_url"] == plan[2]["href"]  # already an export link
    assert (plan[1]["file_name"], plan[2]["file_name"]) == ("index-2021-2022.csv", "index-2023.csv")
    landed = spark.createDataFrame([("index-2023.csv",)], "file_name string")
    assert [r["page_id"] for r in books.download_plan(pages, landed).collect()] == [1]


def test_read_indexes_keeps_quoted_newlines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "index-2024.csv")
    with open(p, "w") as f:
        f.write('Some title text\n\nTitle,Author,Series Name\n"A Book","Doe, Jane","Part one\npart two"\n'
                'Other,Someone,NA\n')
    quoted = books.read_indexes(spark, [p])[0]
    got = {r["Title"]: (r["Author"], r["Series Name"]) for r in quoted.collect()}
    assert got == {"A Book": ("Doe, Jane", "Part one\npart two"), "Other": ("Someone", None)}
    line_based = books.read_indexes(spark, [p], quoted_newlines=False)[0]
    assert line_based.count() == 3  # the split field becomes two rows in the line-based path
