"""Joins, upserts, aggregates and profiles: invariants and idempotence."""

import random

import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from quarry.operators import aggregates as A
from quarry.operators import joins as J
from quarry.operators import quality as Q
from quarry.operators import upsert as U
from quarry.operators import windows as W


def test_salted_full_merge_equals_plain(spark):
    random.seed(1)
    left = [("hot" if i % 3 else f"k{i % 7}", f"l{i}") for i in range(300)] + [(None, "ln")]
    right = [("hot", f"r{i}") for i in range(4)] + [(f"k{i}", f"r{i}") for i in range(10)] + [(None, "rn")]
    a = spark.createDataFrame(left, "k string, a string")
    b = spark.createDataFrame(right, "k string, b string")
    plain = J.full_outer_merge(a, b, ["k"], null_safe=True)
    hot = J.hot_keys(J.key_counts([a, b], ["k"]), ["k"], 1, 20)
    assert rows(hot) == [("hot", 40, 1, True)]
    salted = J.full_outer_merge(a, b, ["k"], null_safe=True, hot=hot)
    assert rows(plain) == rows(salted)
    three = [a, b, b.withColumnRenamed("b", "c")]
    assert rows(J.merge_indexes(three, ["k"], skew_rows=None)) == rows(J.merge_indexes(three, ["k"], skew_rows=7))
    assert plain.count() == 200 * 4 + sum(1 for k, _ in left if k and k != "hot") + 3 + 1


def test_merge_priority_and_key_union(spark):
    d1 = spark.createDataFrame([("t1", "a1", "2021", "s1")], "Title string, Author string, Year string, State string")
    d2 = spark.createDataFrame([("t1", "a1", "2023", None), ("t2", "a2", "2023", None)],
                               "Title string, Author string, Year string, District string")
    d3 = spark.createDataFrame([("t1", "a1", None, "s3"), ("t3", None, "2024", "s4")],
                               "Title string, Author string, Year string, State string")
    out = J.merge_indexes([d1, d2, d3], ["Title", "Author"])
    got = {(r["Title"], r["Author"]): (r["Year"], r["State"]) for r in out.collect()}
    assert got[("t1", "a1")] == ("2021", "s1")
    assert got[("t3", None)] == ("2024", "s4")
    assert set(got) == {("t1", "a1"), ("t2", "a2"), ("t3", None)}


def test_key_multiplicity_predicts_merge_size(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    b = spark.createDataFrame([("x",), ("x",), ("x",), ("z",)], "k string")
    mult = J.key_multiplicity([a, b], ["k"]).agg(F.sum("merged_rows")).first()[0]
    assert mult == J.merge_indexes([a.withColumn("p", F.lit(1)), b.withColumn("q", F.lit(2))], ["k"]).count()


def _status(spark, data):
    return spark.createDataFrame(data, "station_id string, timestamp string, free_bikes long, snap string") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp")) \
        .withColumn("snap", F.col("snap").cast("timestamp"))


def test_upsert_semantics_and_idempotence(spark):
    target = _status(spark, [("s1", "2024-01-01 10:00:00", 5, "2024-01-01 10:00:00"),
                             (None, "2024-01-01 10:00:00", 1, "2024-01-01 10:00:00")]).drop("snap")
    batch = _status(spark, [("s1", "2024-01-01 10:00:00", 7, "2024-01-02 00:00:00"),
                            ("s1", "2024-01-01 10:00:00", 9, "2024-01-01 12:00:00"),
                            ("s2", "2024-01-01 10:00:00", 3, "2024-01-02 00:00:00"),
                            (None, "2024-01-01 10:00:00", 4, "2024-01-02 00:00:00")])
    once = U.merge_upsert(target, batch, ["station_id", "timestamp"], ["free_bikes"],
                          order_desc=["snap"], drop_from_source=["snap"])
    assert rows(once, "station_id", "free_bikes") == [("s1", 7), ("s2", 3), (None, 1), (None, 4)]
    twice = U.merge_upsert(once, batch, ["station_id", "timestamp"], ["free_bikes"],
                           order_desc=["snap"], drop_from_source=["snap"])
    non_null = lambda df: rows(df.filter(F.col("station_id").isNotNull()), "station_id", "free_bikes")
    assert non_null(twice) == non_null(once)
    assert twice.filter(F.col("station_id").isNull()).count() == 3


def test_upsert_version_column_blocks_rollback(spark):
    target = _status(spark, [("s1", "2024-01-01 10:00:00", 5, "2024-01-03 00:00:00")])
    old = _status(spark, [("s1", "2024-01-01 10:00:00", 1, "2024-01-02 00:00:00")])
    out = U.merge_upsert(target, old, ["station_id", "timestamp"], ["free_bikes"], order_desc=["snap"],
                         version_col="snap")
    assert rows(out, "free_bikes") == [(5,)]


def test_upsert_into_partitioned_table(spark, tmp_dir):
    spark.sql(f"CREATE TABLE up_t (station_id string, timestamp timestamp, free_bikes long, d date) "
              f"USING parquet PARTITIONED BY (d) LOCATION '{tmp_dir}/up_t'")
    first = _status(spark, [("s1", "2024-01-01 10:00:00", 5, "2024-01-01 10:00:00"),
                            ("s1", "2024-01-02 10:00:00", 6, "2024-01-02 10:00:00")])
    kw = dict(keys=["station_id", "timestamp"], update_cols=["free_bikes"], partition_col="d",
              partition_expr=F.to_date("timestamp"), order_desc=["snap"], drop_from_source=["snap"])
    U.upsert_into_table(spark, "up_t", first, **kw)
    second = _status(spark, [("s1", "2024-01-02 10:00:00", 8, "2024-01-03 00:00:00")])
    U.upsert_into_table(spark, "up_t", second, **kw)
    assert rows(spark.table("up_t"), "free_bikes") == [(5,), (8,)]


def test_insert_ignore(spark):
    existing = spark.createDataFrame([("banned", "d1")], "status string, description string")
    new = spark.createDataFrame([("banned", "x"), ("new", "y"), ("new", "y")], "status string, description string")
    assert rows(U.insert_ignore(existing, new, ["status"])) == [("new", "y")]


def test_dedup_latest_forms_agree(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 3, 2), ("a", 3, 1), (None, 2, 5), (None, 4, 6)],
                               "k string, t int, id int")
    want = [("a", 3, 2), (None, 4, 6)]
    assert rows(W.dedup_latest(df, ["k"], ["t"], ["id"])) == want
    assert rows(W.dedup_latest_agg(df, ["k"], ["t"], ["id"])) == want


def test_top_n_rank_and_ties(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 1), ("d", 2)], "k string, n long")
    out = W.top_n(df, 2, "n", ["k"], rank_col="rank").collect()
    assert [(r["k"], r["rank"]) for r in out] == [("a", 1), ("b", 2)]


def test_hierarchy_root_is_sum_of_leaves(spark):
    df = spark.createDataFrame([("CA", "d1", "t1"), ("CA", "d2", "t1"), ("TX", "d3", "t2"), ("TX", "d3", "t3")],
                               "State string, District string, Title string")
    out = A.hierarchy_totals(df, ["State", "District"], "Title", root="USA")
    root = out.filter("level = 0").first()["n"]
    leaves = out.filter("level = 2").agg(F.sum("n")).first()[0]
    assert root == leaves == 4


def test_flagged_share_bounds_and_zero_fill(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0)], "Category string, out_of_stock int")
    got = dict(rows(A.flagged_share(df, ["Category"], "out_of_stock", "pct")))
    assert got == {"a": 50.0, "b": 0.0}


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.full(500, 1.5), rng.integers(0, 5, 500)]).tolist()
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = Q.exact_quantiles(df, "v", probs, fetch_limit=100, grid=16, accuracy=100)
    want = np.quantile(np.array(vals), probs)
    assert np.allclose(got, want, rtol=0, atol=1e-12)
    df2 = df.withColumn("w", F.col("v") * 3 + 1).withColumn("e", F.lit(None).cast("double"))
    multi = Q.exact_quantiles_multi(df2, ["v", "w", "e"], probs, fetch_limit=100, grid=16, accuracy=100)
    assert np.allclose(multi["v"], want, rtol=0, atol=1e-12)
    assert np.allclose(multi["w"], np.quantile(np.array(vals) * 3 + 1, probs), rtol=0, atol=1e-9)
    assert multi["e"] == [None] * len(probs)


def test_describe_exact(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 10]], "x double")
    r = Q.describe_exact(df, ["x"]).first()
    assert (r["count"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (5, 1.0, 2.0, 3.0, 4.0, 10.0)


def test_constraint_report(spark):
    fact = spark.createDataFrame([("1", "t", "banned"), ("1", None, "x"), ("2", "t" * 300, None)],
                                 "id string, title string, ban_status string")
    dim = spark.createDataFrame([("banned",)], "status string")
    got = {(r["check"], r["column_name"]): r["violations"] for r in Q.constraint_violations(
        fact, primary_key=["id"], not_null=["title"], max_length={"title": 255},
        foreign_keys=[("ban_status", dim, "status")]).collect()}
    assert got == {("not_null", "title"): 1, ("max_length", "title"): 1, ("primary_key", "id"): 1,
                   ("foreign_key", "ban_status"): 1}


def test_corr_matrix_diagonal_and_symmetry(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.1, 1.0), (3.0, 6.2, 0.0), (4.0, 7.9, 1.0)],
                               "a double, b double, c double")
    got = {(r["x"], r["y"]): r["corr"] for r in A.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "a")] == 1.0 and abs(got[("a", "b")] - got[("b", "a")]) < 1e-15


def test_ols_engines_agree_and_regression_job(spark):
    from quarry.operators import stats as M
    from quarry.plans import covid

    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2))
    y = 3.0 + 2.0 * x[:, 0] - 1.5 * x[:, 1] + rng.normal(scale=0.01, size=400)
    data = [(f"c{i % 7}", i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "country string, date long, f1 double, f2 double, target double")
    normal = M.fit_ols(df, ["f1", "f2"], "target")
    ml = M.fit_ols(df, ["f1", "f2"], "target", engine="ml")
    assert np.allclose(normal.coefficients, ml.coefficients, atol=1e-8)
    assert abs(normal.intercept - 3.0) < 0.01
    metrics, coefs = covid.regression(spark, df, ["f1", "f2"], "target", scale=1.0)
    m = metrics.first()
    assert m["r2"] > 0.99 and 40 < m["n"] < 120
    assert {r["feature"] for r in coefs.collect()} == {"f1", "f2", "intercept"}


def test_salting_spreads_a_hot_key_over_partitions(spark):
    """A key holding most of the left rows lands in one join partition without
    salting and in many with it (AQE off so partitions are not coalesced)."""
    left = spark.createDataFrame([("hot" if i % 10 else f"k{i}", i) for i in range(2000)], "k string, a int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k10", 3)], "k string, b int")
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def hot_partitions(hot):
            joined = J.full_outer_merge(left, right, ["k"], null_safe=True, hot=hot)
            return joined.filter("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        hot = J.hot_key_tables([left, right], ["k"], 100)[1]
        assert rows(hot) == [("hot", 36, 1, True)]
        assert hot_partitions(None) == 1
        assert hot_partitions(hot) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)


def test_upsert_merges_the_null_partition(spark, tmp_dir):
    spark.sql(f"CREATE TABLE up_null (k string, v long, d string) USING parquet PARTITIONED BY (d) "
              f"LOCATION '{tmp_dir}/up_null'")
    kw = dict(keys=["k"], update_cols=["v"], partition_col="d", partition_expr=F.col("p"))
    first = spark.createDataFrame([("a", 1, None), ("b", 2, None)], "k string, v long, p string")
    U.upsert_into_table(spark, "up_null", first.select("k", "v", "p"), **kw)
    second = spark.createDataFrame([("a", 5, None)], "k string, v long, p string")
    U.upsert_into_table(spark, "up_null", second.select("k", "v", "p"), **kw)
    assert rows(spark.table("up_null"), "k", "v") == [("a", 5), ("b", 2)]


def test_upsert_into_unpartitioned_table(spark, tmp_dir):
    spark.sql(f"CREATE TABLE up_flat (k string, v long) USING parquet LOCATION '{tmp_dir}/up_flat'")
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long").write.insertInto("up_flat")
    batch = spark.createDataFrame([("b", 20), ("c", 3)], "k string, v long")
    U.upsert_into_table(spark, "up_flat", batch, ["k"], ["v"], partition_col=None)
    assert rows(spark.table("up_flat")) == [("a", 1), ("b", 20), ("c", 3)]


def test_describe_approx_close_to_exact(spark):
    df = spark.range(0, 10_001).selectExpr("cast(id as double) as x")
    exact = Q.describe_exact(df, ["x"]).first()
    approx = Q.describe_exact(df, ["x"], accuracy=10_000).first()
    assert (exact["p25"], exact["p50"], exact["p75"]) == (2500.0, 5000.0, 7500.0)
    for k in ("p25", "p50", "p75"):
        assert abs(approx[k] - exact[k]) <= 10_001 / 10_000 + 1
    assert approx["count"] == exact["count"] and approx["max"] == exact["max"]


def _largest_partition(spark, left, right, hot):
    """Rows of the largest task of a merge (AQE off so partitions are not coalesced)."""
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = J.full_outer_merge(left, right, ["k"], null_safe=True, hot=hot)
        return joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)


def test_a_key_heavy_on_the_right_is_cut(spark):
    left = spark.createDataFrame([("hot", 1), ("k", 2)], "k string, a int")
    right = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("b"))
    hot = J.hot_key_tables([left, right], ["k"], 100)[1]
    assert rows(hot) == [("hot", 1, 50, True)]
    assert _largest_partition(spark, left, right, hot) < 2500
    assert rows(J.full_outer_merge(left, right, ["k"], hot=hot)) == rows(J.full_outer_merge(left, right, ["k"]))


def test_equal_rows_spread_over_the_tiles(spark):
    left = spark.range(1000).select(F.lit("hot").alias("k"), F.lit(7).alias("a"))
    right = spark.createDataFrame([("hot", 1)], "k string, b int")
    hot = J.hot_key_tables([left, right], ["k"], 50)[1]
    assert rows(hot) == [("hot", 20, 1, True)]
    assert _largest_partition(spark, left, right, hot) < 700
    assert J.full_outer_merge(left, right, ["k"], hot=hot).count() == 1000


def test_heavy_on_both_sides_and_on_one_alone(spark):
    left = spark.createDataFrame([("both", i) for i in range(90)] + [("l", i) for i in range(60)], "k string, a int")
    right = spark.createDataFrame([("both", i) for i in range(70)] + [(None, i) for i in range(55)], "k string, b int")
    hot = J.hot_key_tables([left, right], ["k"], 50)[1]
    assert {r.k: (r.tiles_l > 1, r.tiles_r > 1, r.both) for r in hot.collect()} == {
        "both": (True, True, True), "l": (True, False, False), None: (False, True, False)}
    assert rows(J.full_outer_merge(left, right, ["k"], hot=hot)) == rows(J.full_outer_merge(left, right, ["k"]))


def test_ten_thousand_hot_keys(spark, monkeypatch):
    left = spark.range(40_000).select((F.col("id") % 10_000).cast("string").alias("k"), F.col("id").alias("a"))
    right = spark.range(10_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("b"))
    for most in (100, 100_000):  # broadcast, then joined by a shuffle
        monkeypatch.setattr(J, "BROADCAST_KEYS", most)
        assert J.hot_key_tables([left, right], ["k"], 3)[1].count() == 10_000
        merged = J.merge_indexes([left, right], ["k"], skew_rows=3)
        assert merged.count() == 40_000 and merged.filter("a IS NULL OR b IS NULL").count() == 0
        assert merged.select("a").distinct().count() == 40_000


def _flat(spark, tmp_dir, name, files):
    spark.sql(f"CREATE TABLE {name} (k string, v long) USING parquet LOCATION '{tmp_dir}/{name}'")
    for batch in files:
        spark.createDataFrame(batch, "k string, v long").coalesce(1).write.insertInto(name)


def test_upsert_keeps_files_without_a_key(spark, tmp_dir):
    _flat(spark, tmp_dir, "by_file", [[("a", 1), ("b", 2)], [("c", 3), ("e", 5)], [(None, 9)]])
    before = set(spark.table("by_file").inputFiles())
    batch = spark.createDataFrame([("b", 20), ("d", 4), (None, 8)], "k string, v long")
    report = U.upsert_into_table(spark, "by_file", batch, ["k"], ["v"], None, batch_id=("s", 3))
    assert report == {"files_rewritten": 1, "files_kept": 2, "skipped": False}
    assert rows(spark.table("by_file")) == [("a", 1), ("b", 20), ("c", 3), ("d", 4), ("e", 5), (None, 8), (None, 9)]
    assert len(before & set(spark.table("by_file").inputFiles())) == 2
    for number in (2, 3):
        assert U.upsert_into_table(spark, "by_file", batch, ["k"], ["v"], None, batch_id=("s", number))["skipped"]
    assert spark.table("by_file").count() == 7


def test_a_swap_that_was_cut_off_is_finished(spark, tmp_dir, monkeypatch):
    from quarry.sinks import swap

    _flat(spark, tmp_dir, "cut_off", [[("a", 1)], [("b", 2)]])
    batch = spark.createDataFrame([("b", 20), (None, 8)], "k string, v long")
    want = [("a", 1), ("b", 20), (None, 8)]
    finish = swap._finish

    def fail(*a):
        raise RuntimeError("lost driver")
    monkeypatch.setattr(swap, "_finish", fail)
    for _ in range(2):  # cut off behind the journal, then again while recovering
        try:
            U.upsert_into_table(spark, "cut_off", batch, ["k"], ["v"], None, batch_id=("s", 0))
            raise AssertionError
        except RuntimeError:
            pass
    assert rows(spark.table("cut_off")) == [("a", 1), ("b", 2)]
    monkeypatch.setattr(swap, "_finish", finish)
    assert U.upsert_into_table(spark, "cut_off", batch, ["k"], ["v"], None, batch_id=("s", 0))["skipped"]
    assert rows(spark.table("cut_off")) == want and not swap.recover(spark, "cut_off")


def test_a_failed_pair_leaves_the_old_one(spark, tmp_dir, monkeypatch):
    import pytest

    from quarry.sinks.tables import recreate_dimension_and_fact

    def pair(tag, ref="x"):
        return (spark.createDataFrame([("x", tag)], "s string, d string"), "pair_dim",
                spark.createDataFrame([(1, ref, tag)], "id int, s string, t string"), "pair_fact")
    how = dict(foreign_key=("s", "s"), primary_key=["id"], folder=tmp_dir)

    def held():
        return rows(spark.table("pair_dim")), rows(spark.table("pair_fact"))
    recreate_dimension_and_fact(*pair("old"), **how)
    old = held()
    with pytest.raises(ValueError):
        recreate_dimension_and_fact(*pair("bad", "missing"), **how)
    assert held() == old
    create, calls = type(spark.catalog).createTable, []

    def fails_second(self, *a, **b):
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("catalog gone")
        return create(self, *a, **b)
    monkeypatch.setattr(type(spark.catalog), "createTable", fails_second)
    with pytest.raises(RuntimeError):
        recreate_dimension_and_fact(*pair("new"), **how)
    assert held() == old
    monkeypatch.undo()
    recreate_dimension_and_fact(*pair("new"), **how)
    assert held() == ([("x", "new")], [(1, "x", "new")])
