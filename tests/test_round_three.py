"""Whole-frame ranks, exact splits, states, grouping sets, the two small jobs, and numeric edges."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.functions.scalars import float_to_nullable_long
from quarry.operators import aggregates as A
from quarry.operators import quality as Q
from quarry.operators import stats as M
from quarry.operators import windows as W
from quarry.plans import covid, retail


def test_ranks_of_a_whole_frame(spark):
    df = spark.range(500).select((F.col("id") * 37 % 101).alias("v"), F.col("id"))
    got = {(r.v, r.id): r.Rank for r in W.rank_frame(df.repartition(7), [F.col("v").desc(), F.col("id").asc()]).collect()}
    want = {key: n + 1 for n, key in enumerate(sorted(got, key=lambda k: (-k[0], k[1])))}
    assert got == want and len(got) == 500
    assert W.rank_frame(df.limit(0), [F.col("v")]).count() == 0


@pytest.mark.parametrize("n, fraction, want", [(101, 0.2, 21), (10, 0.2, 2), (1, 0.2, 1), (0, 0.2, 0), (7, 1.0, 7), (7, 0.0, 0)])
def test_split_takes_exactly_its_share(spark, n, fraction, want):
    df = spark.range(n).withColumn("is_test", F.lit("clash"))
    out = M.split_exact(df, ["id"], fraction)
    assert out.filter("is_test").count() == want and out.count() == n
    again = M.split_exact(df.repartition(5), ["id"], fraction)
    assert rows(out) == rows(again)


def test_split_breaks_ties_by_key(spark):
    df = spark.range(40).select("id", F.lit(5).alias("same"), (F.col("id") % 3 - 1).alias("sign"))
    out = M.split_exact(df, ["id"], 0.25, mark=F.col("same"))
    assert rows(out.filter("is_test"), "id") == sorted([(i,) for i in range(10)], key=str)
    # Marks are signed numbers, smallest first.
    out = M.split_exact(df, ["id"], 0.4, mark=F.col("sign") * F.lit(1 << 62))
    assert {r.sign for r in out.filter("is_test").collect()} == {-1, 0} and out.filter("is_test AND sign < 0").count() == 14


def test_states_add_up_to_the_gold_rows(spark):
    data = [("s", "n", f"2024-05-0{d} 1{h}:00:00", (d + h) % 2 or None, d % 3) for d in range(1, 10) for h in range(3)] + [
        (None, "n", "2024-05-01 10:00:00", 0, 0), ("t", None, "2024-05-02 10:00:00", None, None)]
    df = spark.createDataFrame(data, "station_id string, network_id string, timestamp string, free_bikes long, empty_slots long") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert rows(A.utilization_of(A.utilization_states(df))) == rows(A.weekly_utilization(df))


def test_distinct_sets_equal_single_counts(spark):
    data = [(f"a{i % 3}" if i % 7 else None, f"b{i % 4}" if i % 5 else None, i % 11 if i % 6 else None) for i in range(300)]
    df = spark.createDataFrame(data, "a string, b string, v long")
    sets = {"none": [], "a": ["a"], "b": ["b"], "ab": ["a", "b"]}
    got = A.distinct_count_sets(df, sets, "v", "n")
    for label, keys in sets.items():
        one = A.distinct_count_by(df, keys, "v", "n") if keys else A.distinct_counts(df, {"n": "v"})
        assert rows(got.filter(F.col("set") == label).select(*keys, "n")) == rows(one.select(*keys, "n")), label


def test_numbers_out_of_range_are_null(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.9, -1.9, float("nan"), float("inf"), 1e300, None])], "i int, v double")
    assert [r[0] for r in df.orderBy("i").select(float_to_nullable_long("v")).collect()] == [1, -1, None, None, None, None]


def test_quantiles_of_infinities(spark):
    df = spark.createDataFrame([(v,) for v in [float("-inf"), 1.0, 2.0, 3.0, float("inf")]], "v double")
    assert Q.exact_quantiles(df, "v", [0.0, 0.5, 1.0]) == [float("-inf"), 2.0, float("inf")]


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_retail_job(spark, tmp_dir):
    head = "Category,name,mrp,discountPercent,availableQuantity,outOfStock\n"
    raw = _write(f"{tmp_dir}/inventory.csv", head + "Fruit,apple,10,5,3,True\nFruit,pear,20,15,0,False\nVeg,,30,0,1,False\n")
    missing, reports = retail.run(spark, raw, f"{tmp_dir}/clean")
    assert {r.column_name: r.nulls for r in missing.collect()}["name"] == 1
    assert rows(reports["out_of_stock_pct"]) == [("Fruit", 50.0), ("Veg", 0.0)]
    assert [tuple(r) for r in reports["avg_mrp"].collect()] == [("Veg", 30.0), ("Fruit", 15.0)]
    broken = _write(f"{tmp_dir}/broken.csv", head + "Fruit,apple,10,5,3,\nFruit,pear,20,15,0,False\n")
    with pytest.raises(Exception, match="out_of_stock is missing"):
        retail.run(spark, broken, f"{tmp_dir}/none")
    assert not os.path.exists(f"{tmp_dir}/none/_SUCCESS")


def test_country_job(spark, tmp_dir):
    text = "country,code,date,total_cases,total_deaths,total_vaccinations,population,new_cases_smoothed\n"
    for day in range(1, 4):
        text += f"Finland,FIN,2024-01-0{day},{100 * day},{day},{7 * day},1000,{day}.5\n"
        text += f"Norway,NOR,2024-01-0{day},5,5,5,500,1\nWorld,OWID,2024-01-0{day},9,9,9,9,9\nNowhere,,2024-01-0{day},1,1,1,1,1\n"
    out = covid.run(spark, _write(f"{tmp_dir}/raw.csv", text), f"{tmp_dir}/clean")
    assert {r.country for r in spark.read.option("header", True).csv(f"{tmp_dir}/clean").collect()} == {"Finland", "Norway"}
    summary = out["summary"].collect()
    assert [(r.country, r.total_cases, r.cases_per_million, r.population) for r in summary] == [("Finland", 300.0, 300000.0, 1000)]
    assert out["series_new_cases_smoothed"].count() == 3 and "metrics" not in out
