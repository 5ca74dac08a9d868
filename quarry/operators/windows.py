"""Window, sort, limit and set operators: W1, W2, O1-O3, U1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.session import ensure_checkpoint_dir


def _q(name: str) -> str:
    return f"`{name}`"


def dedup_latest(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep the newest row per key (``ROW_NUMBER() OVER (PARTITION BY keys ORDER
    BY order DESC, tiebreak DESC) = 1``).

    Catalyst plans this as a *partial* WindowGroupLimit before the shuffle and a
    final one after it: every map task forwards at most one row per key, so a key
    holding a third of all rows costs one row per task, never one task holding
    the whole group. The output stays hash-partitioned by the keys, so a join on
    them (the upsert) needs no further shuffle. Null keys form one group, as in
    SQL; a null ordering value sorts last.
    """
    w = Window.partitionBy(*[F.col(_q(k)) for k in keys]).orderBy(
        *[F.col(_q(c)).desc_nulls_last() for c in order_desc],
        *[F.col(_q(c)).desc_nulls_last() for c in tiebreak])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def dedup_latest_agg(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                     tiebreak: Sequence[str] = ()) -> DataFrame:
    """W1 as an aggregate: ``max_by(row, (order, tiebreak))`` per key, combined
    partially before the shuffle (a sort-based aggregate, since the row is a
    struct). Same result as ``dedup_latest``."""
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    order = F.struct(*[F.col(_q(c)) for c in list(order_desc) + list(tiebreak)])
    # Keys come from the grouping columns (not the struct) so the output keeps the
    # aggregate's hash partitioning.
    return (df.groupBy(*[F.col(_q(k)).alias(k) for k in keys])
            .agg(F.max_by(F.struct(*[F.col(_q(c)) for c in rest]), order).alias("__w"))
            .select(*[F.col(_q(c)) if c in keys else F.col(f"__w.{_q(c)}").alias(c) for c in cols]))


def sort_desc(df: DataFrame, by: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """O1: sort by a measure descending, keys ascending as tie-breakers (N-11)."""
    return df.orderBy(F.col(_q(by)).desc_nulls_last(), *[F.col(_q(t)).asc() for t in tiebreak])


def top_n(df: DataFrame, n: int, by: str, tiebreak: Sequence[str] = (),
          rank_col: str | None = None) -> DataFrame:
    """O2 / O3 (+W2): top ``n`` rows by ``by`` descending, ties broken by keys.

    ``orderBy().limit()`` plans as TakeOrderedAndProject (each task keeps n rows).
    The 1-based rank (W2) is numbered **after** the limit, on at most n rows, so
    the single-partition window is bounded by n.
    """
    top = sort_desc(df, by, tiebreak).limit(n)
    if rank_col:
        w = Window.orderBy(F.col(_q(by)).desc_nulls_last(), *[F.col(_q(t)).asc() for t in tiebreak])
        top = top.withColumn(rank_col, F.row_number().over(w))
    return top


def rank_frame(df: DataFrame, order: Sequence[Column], rank_col: str = "Rank") -> DataFrame:
    """The 1-based place of every row of a whole sorted frame.

    Rows are dealt in ranges of the order and numbered range by range; a range's first
    number is the rows of all earlier ranges, one count a range. No window spans more than a
    range. The dealt rows are checkpointed, as their ranges come from a sample. Rows that
    ``order`` doesn't tell apart come in any order: end it with a key.
    """
    ensure_checkpoint_dir(df.sparkSession)
    dealt = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()).checkpoint(eager=True)
    offsets, upto = [], 0
    for r in dealt.groupBy("__range").count().orderBy("__range").collect():  # one row a range
        offsets.append((r["__range"], upto))
        upto += r["count"]
    before = df.sparkSession.createDataFrame(offsets, "__range int, __before long")
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return (dealt.join(F.broadcast(before), "__range")
            .withColumn(rank_col, F.col("__before") + own).drop("__range", "__before"))


def top1_pair(df: DataFrame, key: str, by: str) -> DataFrame:
    """O3: the single best (key, value) pair."""
    return top_n(df, 1, by, [key]).select(key, by)


def union_snapshots(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union of snapshot batches; columns matched by name, missing -> null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


