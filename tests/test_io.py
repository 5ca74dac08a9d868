"""Sources and sinks: CSV semantics, latest snapshot, history append, table writes."""

import os
from datetime import datetime

import pytest

from conftest import rows
from quarry.sinks import tables as K
from quarry.sources import files as SRC
from quarry.sources import links as LNK


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_read_csv_infers_like_pandas(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.csv")
    _write(p, "id,score,name,flag\n1,1.5,x,NA\n2,n/a,,-\n3,2,NULL,ok\n")
    df = SRC.read_csv(spark, p)
    assert dict(df.dtypes) == {"id": "bigint", "score": "double", "name": "string", "flag": "string"}
    assert rows(df) == [(1, 1.5, "x", None), (2, None, None, "-"), (3, 2.0, None, "ok")]


def test_read_csv_with_schema_coerces(spark, tmp_dir):
    p = os.path.join(tmp_dir, "s.csv")
    _write(p, "date,product,quantity,price\n2024-01-01,A,10,5.99\nbad,B,x,1\n")
    df = SRC.read_csv(spark, p, {"date": "date", "product": "string", "quantity": "bigint", "price": "double"})
    assert rows(df) == [(datetime(2024, 1, 1).date(), "A", 10, 5.99), (None, "B", None, 1.0)]


def test_csv_sink_writes_empty_text_as_null(spark, tmp_dir):
    df = spark.createDataFrame([("a", ""), ("b", None), ("c", "x")], "k string, v string")
    out = os.path.join(tmp_dir, "out")
    K.write_csv(df, out)
    assert rows(SRC.read_csv_text(spark, out)) == [("a", None), ("b", None), ("c", "x")]


def test_latest_file_and_error(spark, tmp_dir):
    for name in ["raw/station_status_2024-01-01_00-00-00.json", "raw/station_status_2024-02-01_00-00-00.json"]:
        _write(os.path.join(tmp_dir, name), "{}")
    assert SRC.latest_file(spark, os.path.join(tmp_dir, "raw")).endswith("2024-02-01_00-00-00.json")
    with pytest.raises(ValueError):
        SRC.latest_file(spark, os.path.join(tmp_dir, "missing"))


def test_history_append_and_read_back(spark, tmp_dir):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    path = os.path.join(tmp_dir, "history")
    K.append_history(df, path, datetime(2024, 1, 1, 10))
    K.append_history(df.filter("x = 1"), path, datetime(2024, 1, 2, 10))
    back = SRC.read_parquet_glob(spark, path)
    assert rows(back.groupBy("run_ts").count()) == [("20240101_100000", 2), ("20240102_100000", 1)]


def test_append_existing_only(spark, tmp_dir):
    target = spark.createDataFrame([(1, "a")], "id long, name string")
    K.replace_table(target, "io_target", location=os.path.join(tmp_dir, "t"))
    K.append_existing(spark, spark.createDataFrame([(2, "zzz")], "id long, extra string"), "io_target")
    assert rows(spark.table("io_target")) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError):
        K.append_existing(spark, target, "io_absent_table")


def test_clear_dataset_keeps_schema(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    path = os.path.join(tmp_dir, "landing")
    K.write_latest_parquet(df, path)
    K.clear_dataset(spark, df, path)
    back = spark.read.parquet(path)
    assert back.count() == 0 and back.columns == ["id", "name"]


def test_link_helpers(spark):
    pages = spark.createDataFrame([
        (1, "http://x", '<a href="/a">Other</a><a class="b" href="https://docs.google.com/d/1/edit#gid=0">'
                        'Download the index</a><a href="/z">Download the index</a>'),
        (2, "http://y", "<p>no links</p>"),
    ], "page_id long, url string, html string")
    got = rows(LNK.download_links(pages), "page_id", "href")
    assert got == [(1, "https://docs.google.com/d/1/edit#gid=0")]
    links = spark.createDataFrame([("https://docs.google.com/d/1/edit#gid=0",),
                                   ("https://docs.google.com/d/1/export?format=csv",), ("http://other",)], "u string")
    assert [r[0] for r in links.select(LNK.export_link("u")).collect()] == [
        "https://docs.google.com/d/1/export?format=csv", "https://docs.google.com/d/1/export?format=csv",
        "http://other"]
    slugs = spark.createDataFrame([("banned-book-list-2021-2022",), ("2023-banned-book-list",), ("x",)], "s string")
    from quarry.functions.scalars import year_or_unknown
    assert [r[0] for r in slugs.select(year_or_unknown("s")).collect()] == ["2021-2022", "2023", "unknown"]


def test_append_batched_to_table(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    K.replace_table(df, "io_batched", location=os.path.join(tmp_dir, "b"))
    K.append_batched(spark.createDataFrame([(2, "b"), (3, "c")], "id long, name string"), "io_batched")
    assert rows(spark.table("io_batched")) == [(1, "a"), (2, "b"), (3, "c")]


def test_csv_na_tokens_are_exact_like_pandas(spark, tmp_dir):
    import pandas as pd

    text = "a,b,c\n  ,1, NA\n,2,NA \nnan,3,-\n"
    p = os.path.join(tmp_dir, "ws.csv")
    _write(p, text)
    want = pd.read_csv(p).astype(object).where(lambda d: d.notna(), None)
    got = SRC.read_csv(spark, p)
    assert rows(got) == sorted([tuple(r) for r in want.itertuples(index=False)],
                               key=lambda t: tuple((x is None, str(x)) for x in t))


def test_csv_type_inference_like_pandas(spark, tmp_dir):
    p = os.path.join(tmp_dir, "types.csv")
    _write(p, "a,b,c,d,e,f\nTrue,1,1.5,x,1,true\nfalse,2,,y,2.0,TRUE\n,3,3,,NA,False\n")
    df = SRC.read_csv(spark, p)
    assert dict(df.dtypes) == {"a": "boolean", "b": "bigint", "c": "double", "d": "string", "e": "double",
                               "f": "boolean"}
    assert [r["a"] for r in df.orderBy("b").collect()] == [True, False, None]


def test_anchor_text_inside_nested_tags(spark):
    pages = spark.createDataFrame([
        (1, "u1", '<a href="/a"><span><b>Download the index</b></span></a>'),
        (2, "u2", '<a href="/b">Download <b>the</b> index</a><a href="/c">Download the index</a>'),
        (3, "u3", "<a class='x' href='/d'>Download the index</a>"),
    ], "page_id long, url string, html string")
    assert rows(LNK.download_links(pages), "page_id", "href") == [(1, "/a"), (2, "/c"), (3, "/d")]
