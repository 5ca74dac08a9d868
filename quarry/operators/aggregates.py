"""Aggregations: A1-A15.

All are hash aggregates with a partial (map-side) phase, so a hot group is
combined inside each task before the shuffle and never arrives as one unbounded
list. Distinct counts use Spark's Expand rewrite, which also aggregates partially.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalars import row_summary, week_start_monday
from quarry.operators.filters import is_flagged
from quarry.semantics import group_non_null


def _q(name: str) -> str:
    return f"`{name}`"


def mean_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
            drop_null_keys: bool = True, suffix: str = "") -> DataFrame:
    """Mean of each measure per group (pandas drops null keys, N-1)."""
    src = group_non_null(df, keys) if drop_null_keys else df
    return src.groupBy(*[F.col(_q(k)) for k in keys]).agg(
        *[F.avg(F.col(_q(m))).alias(f"{m}{suffix}") for m in measures])


def count_where(df: DataFrame, keys: Sequence[str], predicate: Column,
                name: str = "n") -> DataFrame:
    """A2: filtered row count per group; groups with no match are absent."""
    return (group_non_null(df.filter(predicate), keys)
            .groupBy(*[F.col(_q(k)) for k in keys]).agg(F.count(F.lit(1)).alias(name)))


def flagged_share(df: DataFrame, keys: Sequence[str], flag: str | Column,
                  name: str = "pct", scale: float = 100.0) -> DataFrame:
    """A3 (+J8): ``scale * count_if(flag) / count(*)`` per group in one pass; a group
    with no flagged row gets 0 (the zero-fill the outer-aligned division needed)."""
    flag_col = is_flagged(flag) if isinstance(flag, str) else F.coalesce(flag, F.lit(False))
    return (group_non_null(df, keys).groupBy(*[F.col(_q(k)) for k in keys])
            .agg((F.lit(scale) * F.count_if(flag_col) / F.count(F.lit(1))).alias(name)))


def share_over(predicate: Column, threshold: float) -> Column:
    """A4: ``count_if(pred) / count(*) > threshold`` (strict), as an aggregate expression."""
    return (F.count_if(F.coalesce(predicate, F.lit(False))) / F.count(F.lit(1))) > F.lit(threshold)


def weekly_utilization(status: DataFrame, threshold: float = 0.8,
                       ts: str = "timestamp") -> DataFrame:
    """A5 (+D1, A4): per (station, network, Monday week) utilisation summary.

    Warehouse semantics: GROUP BY keeps null keys, so no null-key drop here.
    """
    return (status
            .groupBy("station_id", "network_id", week_start_monday(ts).alias("week_start"))
            .agg(share_over(F.col("empty_slots") == 0, threshold).alias("is_frequently_full"),
                 share_over(F.col("free_bikes") == 0, threshold).alias("is_frequently_empty"),
                 F.avg("free_bikes").alias("avg_free_bikes"),
                 F.avg("empty_slots").alias("avg_empty_slots")))


def utilization_states(status: DataFrame, ts: str = "timestamp") -> DataFrame:
    """A5 as mergeable states: sums and counts per (station, network, day). States of the days of a
    week add up to what ``weekly_utilization`` computes from the rows (see ``utilization_of``)."""
    return (status.groupBy("station_id", "network_id", F.to_date(ts).alias("day"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("empty_slots") == 0).alias("n_full"),
                 F.count_if(F.col("free_bikes") == 0).alias("n_empty"),
                 F.sum("free_bikes").alias("sum_free"), F.count("free_bikes").alias("n_free"),
                 F.sum("empty_slots").alias("sum_slots"), F.count("empty_slots").alias("n_slots")))


def utilization_of(states: DataFrame, threshold: float = 0.8) -> DataFrame:
    """A5 from states: the same rows and columns as ``weekly_utilization``."""
    total = lambda c: F.sum(c)
    mean = lambda s, n: F.try_divide(F.sum(s).cast("double"), F.sum(n))
    return (states.groupBy("station_id", "network_id", week_start_monday("day").alias("week_start"))
            .agg((total("n_full") / total("n") > F.lit(threshold)).alias("is_frequently_full"),
                 (total("n_empty") / total("n") > F.lit(threshold)).alias("is_frequently_empty"),
                 mean("sum_free", "n_free").alias("avg_free_bikes"), mean("sum_slots", "n_slots").alias("avg_empty_slots")))


def distinct_count_sets(df: DataFrame, sets: Mapping[str, Sequence[str]], target: str,
                        name: str = "n_distinct") -> DataFrame:
    """A6, A7, A10 and A12 together: (set, <all keys>, ``name``), the distinct non-null ``target`` values
    per key set (null keys dropped; the empty set is the whole frame, without a row if that is empty).

    One scan and one shuffle of the data: rows are made distinct per (set, its keys, target) by
    one aggregate over grouping sets, which Spark combines in the tasks first; the count
    that follows only sees distinct combinations.
    """
    keys = list(dict.fromkeys(k for own in sets.values() for k in own))
    grouped = [[F.col(_q(k)) for k in own] + [F.col(_q(target))] for own in sets.values()]
    columns = [F.col(_q(k)) for k in [*keys, target]]
    distinct = df.select(*columns).groupingSets(grouped, *columns).agg(F.grouping_id().alias("__gid"))
    out = None
    bit = {k: 1 << (len(keys) - i) for i, k in enumerate(keys)}  # the target is the lowest bit
    which, sound = F.lit(None).cast("string"), F.lit(True)
    for label, own in sets.items():
        gid = sum(b for k, b in bit.items() if k not in own)
        which = F.when(F.col("__gid") == gid, F.lit(label)).otherwise(which)
        for k in own:
            sound = sound & ((F.col("__gid") != gid) | F.col(_q(k)).isNotNull())
    out = distinct.filter(sound).withColumn("set", which)
    return out.groupBy("set", *[F.col(_q(k)) for k in keys]).agg(F.count(F.col(_q(target))).alias(name))


def distinct_count_by(df: DataFrame, keys: Sequence[str], target: str,
                      name: str = "n_distinct", approx: bool = False) -> DataFrame:
    """``nunique`` of ``target`` per key set (null keys dropped, nulls not counted).
    ``approx=True`` swaps in HyperLogLog++ for very large cardinalities."""
    agg = (F.approx_count_distinct(F.col(_q(target))) if approx
           else F.count_distinct(F.col(_q(target))))
    return group_non_null(df, keys).groupBy(*[F.col(_q(k)) for k in keys]).agg(agg.alias(name))


def distinct_counts(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Several global distinct counts in one aggregate (``{alias: column}``)."""
    return df.agg(*[F.count_distinct(F.col(_q(c))).alias(a) for a, c in targets.items()])


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """``groupby(keys).size()`` (null keys dropped)."""
    return (group_non_null(df, keys).groupBy(*[F.col(_q(k)) for k in keys])
            .agg(F.count(F.lit(1)).alias(name)))


def last_non_null(df: DataFrame, keys: Sequence[str], order_col: str,
                  columns: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """Per group and per column, the value at the greatest ``order_col`` among
    rows where that column is not null (pandas ``groupby().last()``, ordered
    explicitly, N-10). ``max_by`` aggregates partially, so no group is gathered."""
    order = F.struct(F.col(_q(order_col)), *[F.col(_q(t)) for t in tiebreak]) if tiebreak \
        else F.col(_q(order_col))
    aggs = []
    for c in columns:
        val = F.col(_q(c))
        aggs.append(F.max_by(val, F.when(val.isNotNull(), order)).alias(c))
    return group_non_null(df, keys).groupBy(*[F.col(_q(k)) for k in keys]).agg(*aggs)


def pivot_distinct(df: DataFrame, index: str, pivot_col: str, values: Sequence[str],
                   target: str) -> DataFrame:
    """A10: index x pivot-value matrix of distinct counts, missing -> 0.

    The (index, pivot, target) triples are deduplicated first (one partial
    aggregate), then counted per pivot value: this avoids expanding every row once
    per pivot value, which a pivot over ``count(distinct)`` would do. The values
    are listed explicitly, so Spark runs no extra job to discover them."""
    src = group_non_null(df, [index, pivot_col])
    # Null targets stay in the dedup so a group whose targets are all null still
    # appears (with 0), as a pandas ``nunique`` group does; ``count`` skips them.
    triples = src.select(F.col(_q(index)), F.col(_q(pivot_col)), F.col(_q(target))).distinct()
    wide = triples.groupBy(F.col(_q(index))).pivot(pivot_col, list(values)).agg(F.count(F.col(_q(target))))
    return wide.fillna(0, subset=list(values))


def with_row_total(df: DataFrame, columns: Sequence[str], name: str = "total") -> DataFrame:
    """Row-wise sum over (pivoted) columns."""
    total = None
    for c in columns:
        term = F.coalesce(F.col(_q(c)), F.lit(0))
        total = term if total is None else total + term
    return df.withColumn(name, total)


def with_row_summary(df: DataFrame, columns: Sequence[str], name: str = "summary") -> DataFrame:
    """T9 over a pivot: ``col: n, col: n``."""
    return df.withColumn(name, row_summary(columns))


def hierarchy_totals(df: DataFrame, levels: Sequence[str], target: str,
                     root: str = "ALL", name: str = "n") -> DataFrame:
    """Totals for root -> level1 -> level2 where every node is the **sum of leaf
    distinct counts** (not a distinct count of the union). Leaves come from A6, then
    ``rollup`` adds the parents. ``level`` tells the depth (0 = root)."""
    leaves = distinct_count_by(df, levels, target, name="leaf")
    rolled = leaves.rollup(*[F.col(_q(l)) for l in levels]).agg(
        F.sum("leaf").cast("long").alias(name),
        F.grouping_id().alias("_gid"))
    depth = F.lit(len(levels))
    for i in range(len(levels)):
        depth = depth - F.col("_gid").bitwiseAND(F.lit(1 << i)).cast("boolean").cast("int")
    return rolled.select(F.lit(root).alias("root"), *[F.col(_q(l)) for l in levels],
                         depth.alias("level"), F.col(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of one column."""
    return df.select(F.col(_q(column))).na.drop().distinct()


def corr_matrix(df: DataFrame, columns: Sequence[str], listwise: bool = True) -> DataFrame:
    """Pearson correlation of every ordered column pair, in one aggregate,
    returned long as (x, y, corr). ``listwise`` first drops rows with any null in
    the set, as ``DataFrame.dropna().corr()`` does. A constant column correlates with
    nothing, itself included: null."""
    src = df.select(*[F.col(_q(c)).cast("double").alias(c) for c in columns])
    if listwise:
        src = src.na.drop("any")
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    spread = [F.stddev_samp(F.col(_q(c))) for c in columns]
    at = {c: i for i, c in enumerate(columns)}
    wide = src.agg(*[F.try_divide(F.covar_samp(F.col(_q(a)), F.col(_q(b))), spread[at[a]] * spread[at[b]]).alias(f"c{i}")
                     for i, (a, b) in enumerate(pairs)],
                   *[s.alias(f"s{i}") for i, s in enumerate(spread)])
    rows = [f"'{c}', '{c}', if(s{i} > 0, 1.0D, CAST(NULL AS DOUBLE))" for i, c in enumerate(columns)]
    for i, (a, b) in enumerate(pairs):
        rows.append(f"'{a}', '{b}', c{i}")
        rows.append(f"'{b}', '{a}', c{i}")
    return wide.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) as (x, y, corr)")
