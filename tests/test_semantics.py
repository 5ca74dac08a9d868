"""Null, NaN, rounding and tie rules N-1..N-11, and the reference's own unit tests."""

from pyspark.sql import functions as F

from conftest import rows
from quarry import semantics as SEM
from quarry.functions import scalars as S
from quarry.operators import aggregates as A
from quarry.operators import filters as FL
from quarry.operators import joins as J
from quarry.plans import covid


def test_reference_excludes_aggregates(spark):
    df = spark.createDataFrame([("World", "AGG_WRL"), ("Africa", "AGG_AFR"), ("South Africa", "ZAF")],
                               "country string, code string")
    out = covid.clean(df).collect()
    assert len(out) == 1 and out[0]["country"] == "South Africa"


def test_reference_drops_missing_codes(spark):
    df = spark.createDataFrame([("South Africa", "ZAF"), ("Namibia", None)], "country string, code string")
    out = covid.clean(df).collect()
    assert len(out) == 1 and out[0]["country"] == "South Africa"


def test_n1_group_by_drops_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("a", 3.0)], "k string, v double")
    assert rows(A.mean_by(df, ["k"], ["v"])) == [("a", 2.0)]
    assert rows(A.count_by(df, ["k"])) == [("a", 2)]


def test_n1_warehouse_group_by_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, "n", "2024-01-01 10:00:00", 0, 3)],
                               "station_id string, network_id string, timestamp string, free_bikes long, empty_slots long")
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    out = A.weekly_utilization(df).collect()
    assert len(out) == 1 and out[0]["station_id"] is None


def test_n2_merge_matches_null_keys(spark):
    a = spark.createDataFrame([("t", None, "x")], "Title string, Author string, A string")
    b = spark.createDataFrame([("t", None, "y")], "Title string, Author string, B string")
    out = J.merge_indexes([a, b], ["Title", "Author"]).collect()
    assert len(out) == 1 and (out[0]["A"], out[0]["B"]) == ("x", "y")


def test_n3_not_in_keeps_nulls(spark):
    df = spark.createDataFrame([("World",), (None,), ("Chile",)], "country string")
    assert rows(FL.exclude_values(df, "country", ["World"])) == [("Chile",), (None,)]


def test_n4_nan_skipped_by_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 3.0)], "k string, v double")
    out = A.mean_by(SEM.nans_to_nulls(df), ["k"], ["v"]).collect()
    assert out[0]["v"] == 2.0


def test_n5_na_tokens(spark):
    df = spark.createDataFrame([("NA",), ("n/a",), ("",), ("-",), ("null",), ("x",)], "v string")
    out = [r[0] for r in df.select(SEM.na_to_null("v")).collect()]
    assert out == [None, None, None, "-", None, "x"]


def test_n6_int_flag_is_true(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "f int")
    assert [r[0] for r in df.select(FL.is_flagged("f")).collect()] == [True, False, False]


def test_n7_half_even(spark):
    df = spark.createDataFrame([(0.25,), (0.35,), (2.5,), (3.5,)], "x double")
    out = df.select(S.round_half_even("x", 1).alias("r1"), S.round_half_even("x", 0).alias("r0")).collect()
    assert [r["r0"] for r in out] == [0.0, 0.0, 2.0, 4.0]
    assert out[0]["r1"] == 0.2


def test_n8_bad_casts_become_null(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(S.coerce_numeric("v")).collect()] == [12.0, None, None]


def test_n9_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(SEM.safe_div("a", "b")).collect()] == [None, 0.5]


def test_n10_last_non_null_looks_back(spark):
    df = spark.createDataFrame([("c", "2024-01-01", 1.0, 10.0), ("c", "2024-01-02", None, 20.0),
                                ("c", "2024-01-03", None, None)],
                               "country string, date string, a double, b double")
    out = A.last_non_null(df.withColumn("date", F.to_date("date")), ["country"], "date", ["a", "b"]).collect()
    assert (out[0]["a"], out[0]["b"]) == (1.0, 20.0)


def test_zero_population_gives_null_rate(spark):
    df = spark.createDataFrame([("c", "2024-01-01", 5.0, 1.0, 0.0, 0.0)],
                               "country string, date string, total_cases double, total_deaths double, "
                               "total_vaccinations double, population double")
    out = covid.latest_summary(df.withColumn("date", F.to_date("date"))).collect()[0]
    assert out["cases_per_million"] is None and out["population"] == 0


def test_bool_parsing_h4(spark):
    df = spark.createDataFrame([("true",), ("false",), ("1",), ("0",), (None,), ("1.0",), ("abc",)], "v string")
    out = [r[0] for r in df.select(S.to_bool_default_false("v")).collect()]
    assert out == [True, False, True, False, False, True, False]


def test_timestamp_parsing_c4(spark):
    df = spark.createDataFrame([("2024-05-01T10:00:00Z",), ("",), ("None",), ("garbage",),
                                (" 2024-05-01 10:00:00 ",)], "v string")
    out = [r[0] for r in df.select(S.timestamp_to_epoch_micros(S.parse_timestamp_utc("v"))).collect()]
    assert out[0] == out[4] == 1714557600 * 1_000_000
    assert out[1:4] == [None, None, None]


def test_year_normalisation_t4_t5(spark):
    df = spark.createDataFrame([("2021-2022",), ("2022.0",), ("2023",), (None,), ("20x-abc",)], "y string")
    assert [r[0] for r in df.select(S.normalize_year("y")).collect()] == ["2022", "2022", "2023", None, None]
    d = spark.createDataFrame([("July 2021",), ("   ",), (None,)], "d string")
    assert [r[0] for r in d.select(S.last_token("d")).collect()] == ["2021", None, None]


def test_name_reversal_t3(spark):
    df = spark.createDataFrame([("King, Stephen",), ("Plato",), ("a, b, c",), (None,)], "a string")
    assert [r[0] for r in df.select(S.reverse_name("a")).collect()] == ["Stephen King", "Plato", "c b a", None]


def test_float_to_int_c9(spark):
    df = spark.createDataFrame([(2.0,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(S.float_to_nullable_long("x")).collect()] == [2, None, None]


def test_latest_summary_rounding_and_types(spark):
    df = spark.createDataFrame([("c", "2024-01-01", 10.5, 2.5, 12.5, 4.0e6),
                                ("c", "2024-01-02", 11.5, None, 13.5, 4.0e6)],
                               "country string, date string, total_cases double, total_deaths double, "
                               "total_vaccinations double, population double")
    r = covid.latest_summary(df.withColumn("date", F.to_date("date"))).first()
    assert (r["total_cases"], r["total_deaths"], r["total_vaccinations"], r["population"]) == (12.0, 2.0, 14, 4000000)
    assert r["cases_per_million"] == 2.9 and r["deaths_per_million"] == 0.6


def test_epoch_units_and_date_formats(spark):
    df = spark.createDataFrame([(1714557600,)], "s long")
    exprs = {"s": S.epoch_to_timestamp("s", "s"),
             "ms": S.epoch_to_timestamp(F.col("s") * 1000, "ms"),
             "us": S.epoch_to_timestamp(F.col("s") * 1_000_000, "us"),
             "ns": S.epoch_to_timestamp(F.col("s") * 1_000_000_000, "ns")}
    r = df.select(*[S.timestamp_to_epoch_micros(e).alias(k) for k, e in exprs.items()]).first()
    assert set(r) == {1714557600 * 1_000_000}
    d = spark.createDataFrame([("01/05/2024",), ("bad",)], "t string")
    got = [r[0] for r in d.select(S.parse_date("t", "dd/MM/yyyy")).collect()]
    assert str(got[0]) == "2024-05-01" and got[1] is None
