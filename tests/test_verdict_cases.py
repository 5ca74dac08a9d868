"""Cases that round 1 got wrong."""

import pytest
from pyspark.sql import functions as F

from quarry.functions.scalars import coerce_numeric, parse_date, to_bool_default_false
from quarry.operators.aggregates import corr_matrix
from quarry.operators.stats import ols_normal_equations
from quarry.operators.upsert import upsert_into_table
from quarry.sinks.tables import append_batched
from quarry.sources.files import infer_types


def test_type_letters_are_no_numbers(spark):
    df = spark.createDataFrame([("5D", 0), ("12f", 1), ("1e3", 2), (" 7 ", 3), ("inf", 4)], "v string, i int")
    got = [r[0] for r in df.orderBy("i").select(coerce_numeric("v")).collect()]
    assert got == [None, None, 1000.0, 7.0, float("inf")]
    assert infer_types(df.filter("i < 2").select("v")) == {"v": "string"}


def test_only_finite_numbers_are_true(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["nan", "inf", "5D", "2", "0.0", "true", None])], "i int, v string")
    assert [r[0] for r in df.orderBy("i").select(to_bool_default_false("v")).collect()] == [
        False, False, False, True, False, True, False]


def test_bad_dates_are_null(spark):
    df = spark.createDataFrame([("2024-01-02",), ("x",)], "v string")
    assert [str(r[0]) for r in df.select(parse_date("v")).collect()] == ["2024-01-02", "None"]


def test_constant_column_correlates_with_nothing(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.5, 5.0)], "a double, b double, c double")
    got = {(r.x, r.y): r["corr"] for r in corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got["c", "c"] is None and got["a", "c"] is None and got["a", "a"] == 1.0 and got["a", "b"] > 0.99


def test_collinear_features_are_solved(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 3.0 * i + 1) for i in range(9)], "a double, b double, y double")
    beta, intercept = ols_normal_equations(df, ["a", "b"], "y")
    assert abs(beta[0] + 2 * beta[1] - 3) < 1e-6 and abs(intercept - 1) < 1e-6


def test_append_goes_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS by_name")
    spark.createDataFrame([(1, 2)], "a int, b int").write.saveAsTable("by_name")
    append_batched(spark.createDataFrame([(20, 10)], "b int, a int"), "by_name")
    assert sorted(tuple(r) for r in spark.table("by_name").select("a", "b").collect()) == [(1, 2), (10, 20)]


@pytest.mark.parametrize("part", ["2024-01-01 00:00", "a/b%c", None])
def test_upsert_keeps_rows_of_partitions_with_odd_names(spark, part):
    spark.sql("DROP TABLE IF EXISTS odd_parts")
    rows = spark.createDataFrame([("a", 1, part), ("b", 1, part), ("c", 1, "other")], "k string, v int, p string")
    rows.write.partitionBy("p").saveAsTable("odd_parts")
    batch = spark.createDataFrame([("a", 2, part)], "k string, v int, p string")
    upsert_into_table(spark, "odd_parts", batch, ["k"], ["v"], "p", F.col("p"))
    assert sorted(tuple(r)[:2] for r in spark.table("odd_parts").select("k", "v").collect()) == [("a", 2), ("b", 1), ("c", 1)]
