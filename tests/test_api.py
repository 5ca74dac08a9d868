"""Public helpers the jobs expose but the driver queries do not call directly."""

from datetime import datetime

from conftest import rows
from quarry.functions import scalars as S
from quarry.operators import joins as J
from quarry.plans import bike, covid, sales
from quarry.sources import preamble as PR


def test_explode_children_keeps_parent_fields(spark):
    df = spark.createDataFrame([(1, [10, 20]), (2, []), (3, None)], "id long, xs array<long>")
    assert rows(S.explode_children(df, "xs", "x", keep=["id"])) == [(1, 10), (1, 20)]


def test_exists_in_semi_and_anti(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, s string")
    dim = spark.createDataFrame([("a",), ("a",)], "status string")
    assert rows(J.exists_in(fact, "s", dim, "status"), "id") == [(1,)]
    assert rows(J.exists_in(fact, "s", dim, "status", negate=True), "id") == [(2,), (3,)]


def test_covid_correlations_listwise(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)],
                               "new_cases_per_million double, stringency_index double")
    got = {(r["x"], r["y"]): r["corr"] for r in covid.correlations(df).collect()}
    assert abs(got[("new_cases_per_million", "stringency_index")] - 1.0) < 1e-12


def test_sales_preview_stats(spark):
    df = spark.createDataFrame([(10, 5.99), (5, 12.49), (7, 9.99)], "quantity long, price double")
    got = {r["column_name"]: r for r in sales.preview_stats(sales.clean(df)).collect()}
    assert got["quantity"]["p50"] == 7.0 and got["quantity"]["count"] == 3
    assert abs(got["total"]["max"] - 69.93) < 1e-9


def test_merge_master_updates_only_mutable_columns(spark):
    fields = ", ".join(f"{n} {t}" for n, t in bike.MASTER_FIELDS)
    master = spark.createDataFrame([("n", "N", "s1", 40.7, -74.0, datetime(2024, 5, 6, 10), 1, 1, "u", True, True,
                                     False, 0)], fields)
    staging = spark.createDataFrame([("n", "N", "s1", 40.8, -74.0, datetime(2024, 5, 6, 10), 9, 0, "v", False, True,
                                      True, 2, datetime(2024, 5, 6, 11))], fields + ", snapshot_time timestamp")
    out = bike.merge_master(master, staging).first()
    assert (out["free_bikes"], out["ebikes"], out["latitude"], out["extra_uid"]) == (9, 2, 40.7, "u")


def test_parse_csv_lines_unions_layouts(spark):
    lines = spark.createDataFrame([("f1", 0, "Title,Author"), ("f1", 1, "t,a"), ("f2", 0, "x"),
                                   ("f2", 1, "Author,Title,Year"), ("f2", 2, "b,u,2024")],
                                  "file string, pos long, line string")
    parsed = PR.parse_csv_lines(PR.strip_preamble(lines))
    assert rows(parsed.select("Title", "Author", "Year")) == [("t", "a", None), ("u", "b", "2024")]
