"""Keyed upserts on plain Parquet tables.

Parquet tables accept no ``MERGE INTO``, so the merge is a full outer join of
the target's rows with the deduplicated batch. Only the files that hold a key of
the batch are read and rewritten; all others stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.windows import dedup_latest
from quarry.sinks import swap


def _q(name: str) -> str:
    return f"`{name}`"


def merge_upsert(target: DataFrame, staging: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str], order_desc: Sequence[str] = (),
                 tiebreak: Sequence[str] = (), drop_from_source: Sequence[str] = (),
                 version_col: str | None = None) -> DataFrame:
    """``MERGE target USING dedup(staging) ON keys`` as a DataFrame.

    * the batch is deduplicated per key, newest ``order_desc`` first (W1);
    * matched target rows take ``update_cols`` from the batch, other columns stay;
    * unmatched batch rows are inserted with the target's columns;
    * keys compare with plain ``=`` (J3): a null key never matches, so such rows
      are always inserted and target rows with null keys are kept as they are;
    * with ``version_col`` (kept on the target), a matched row is updated only if
      the batch row is at least as new, so replaying or reordering batches
      cannot roll a row back (H-2).
    """
    src = dedup_latest(staging, keys, order_desc, tiebreak) if order_desc else staging
    src = src.drop(*drop_from_source)
    cols = target.columns
    # Rows with a null key can never match, yet a join would hash them all into one
    # shuffle partition; they bypass the join (kept / inserted) and are unioned back.
    has_keys = None
    for k in keys:
        term = F.col(_q(k)).isNotNull()
        has_keys = term if has_keys is None else has_keys & term
    target_nulls = target.filter(~has_keys).select(*[F.col(_q(c)) for c in cols])
    source_nulls = src.filter(~has_keys).select(*[F.col(_q(c)) for c in cols])
    t = target.filter(has_keys).select(*[F.col(_q(c)).alias(f"t__{c}") for c in cols],
                                       F.lit(True).alias("__t"))
    s = src.filter(has_keys).select(*[F.col(_q(c)).alias(f"s__{c}") for c in cols],
                                    F.lit(True).alias("__s"))
    cond = None
    for k in keys:
        term = F.col(_q(f"t__{k}")) == F.col(_q(f"s__{k}"))
        cond = term if cond is None else cond & term
    j = t.join(s, cond, "full")
    take_src = F.col("__s").isNotNull()
    if version_col:
        tv, sv = F.col(_q(f"t__{version_col}")), F.col(_q(f"s__{version_col}"))
        take_src = take_src & (F.col("__t").isNull() | tv.isNull() | (sv >= tv))
        update_cols = [*update_cols, version_col]
    out = []
    for c in cols:
        tc, sc = F.col(_q(f"t__{c}")), F.col(_q(f"s__{c}"))
        if c in update_cols:
            out.append(F.when(take_src, sc).otherwise(tc).alias(c))
        else:
            out.append(F.when(F.col("__t").isNotNull(), tc).otherwise(sc).alias(c))
    return j.select(*out).unionByName(target_nulls).unionByName(source_nulls)


def insert_ignore(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not yet present (``ON CONFLICT DO
    NOTHING``); duplicates inside the batch keep one row per key."""
    fresh = new.dropDuplicates(list(keys))
    cond = None
    for k in keys:
        term = fresh[_q(k)] == existing[_q(k)]
        cond = term if cond is None else cond & term
    return fresh.join(existing.select(*keys), cond, "left_anti")


def upsert_into_table(spark: SparkSession, table: str, staging: DataFrame, keys: Sequence[str],
                      update_cols: Sequence[str], partition_col: str | None, partition_expr=None,
                      order_desc: Sequence[str] = (), tiebreak: Sequence[str] = (),
                      drop_from_source: Sequence[str] = (),
                      version_col: str | None = None,
                      cluster_by: Sequence[str] = (),
                      batch_id: tuple[str, int] | None = None) -> dict[str, int | bool]:
    """K11 against a Parquet catalog table, partitioned by ``partition_col`` or not at all.

    Reads the key columns of the partitions the batch touches (their list is small: one
    value per day in the batch), within the batch's key ranges, and finds the files that
    hold one of its keys. Those files alone are merged; the result is written aside, rows
    sorted by ``cluster_by`` inside each file (so that ranges stay narrow), and swapped in
    file by file (``sinks.swap``): a run that is cut off is finished by the next one.

    ``batch_id`` (stream, number) enters the batch in the table's ledger together with its
    rows; a batch that the ledger already has is left out, so a replay inserts nothing,
    not even rows with null keys. Returns what was done: ``files_rewritten`` and
    ``files_kept`` of the touched partitions, and whether the batch was ``skipped``.
    """
    swap.recover(spark, table)
    if batch_id:
        last = swap.applied(spark, table, batch_id[0])
        if last is not None and batch_id[1] <= last:
            return {"files_rewritten": 0, "files_kept": 0, "skipped": True}
    # The batch is read several times (partition values, key ranges, keys, merge): keep it
    # for the duration of the upsert instead of recomputing it from the source.
    batch = (staging if partition_col is None else staging.withColumn(partition_col, partition_expr)).persist()
    try:
        target = spark.table(table)
        held = target.filter(_touched(batch, partition_col))
        hits = _files_with_keys(held, batch, keys)
        old = held.filter(F.col("_metadata.file_path").isin(hits)) if hits else target.filter(F.lit(False))
        merged = merge_upsert(old.select(*[F.col(_q(c)) for c in target.columns]), batch, keys, update_cols,
                              order_desc, tiebreak, drop_from_source, version_col)
        out = merged.select(*[F.col(_q(c)).cast(target.schema[c].dataType) for c in target.columns])
        order = [*([partition_col] if partition_col else []), *cluster_by]
        if partition_col:  # few files a partition: small ones share a task, large ones are split
            out = out.hint("rebalance", F.col(_q(partition_col)))
        writer = (out.sortWithinPartitions(*order) if cluster_by else out).write
        staged = swap.staging(spark, table)
        (writer.partitionBy(partition_col) if partition_col else writer).parquet(staged)
        report = {"files_rewritten": len(hits), "files_kept": len(held.inputFiles()) - len(hits), "skipped": False}
        swap.swap(spark, table, staged, hits, batch_id)
        return report
    finally:
        batch.unpersist()


def _touched(batch: DataFrame, partition_col: str | None):
    """The partitions of the batch, by their typed values, never by the escaped names of the catalog."""
    if partition_col is None:
        return F.lit(True)
    parts = [r[0] for r in batch.select(partition_col).distinct().collect()]
    values = [p for p in parts if p is not None]
    inside = F.col(_q(partition_col)).isin(values) if values else F.lit(False)
    return inside | F.col(_q(partition_col)).isNull() if None in parts else inside


def _files_with_keys(held: DataFrame, batch: DataFrame, keys: Sequence[str]) -> list[str]:
    """The files of ``held`` that hold a key of the batch. The key ranges reach the scan, which
    leaves out row groups by their statistics; only key columns are read."""
    bounds = batch.agg(*[f(_q(k)).alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    near = held
    for i, k in enumerate(keys):
        if bounds[f"lo{i}"] is None:
            return []
        near = near.filter(F.col(_q(k)).between(F.lit(bounds[f"lo{i}"]), F.lit(bounds[f"hi{i}"])))
    asked = batch.select(*[F.col(_q(k)) for k in keys]).distinct()
    found = (near.select(F.col("_metadata.file_path").alias("__file"), *[F.col(_q(k)) for k in keys])
             .join(asked, list(keys), "left_semi"))
    return [r[0] for r in found.select("__file").distinct().collect()]  # files of the touched partitions
