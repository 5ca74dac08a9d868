"""Sinks and table operations: K1-K9, K12.

Every write goes through Spark's commit protocol (task output is staged and
committed once), so a lost executor re-runs its task without leaving partial
files behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.projections import project_to


def write_csv(df: DataFrame, path: str, empty_as_null: bool = True) -> None:
    """K1: CSV with a header and no index column. ``''`` is written as an empty
    field and read back as null (H-13)."""
    out = df
    if empty_as_null:
        out = df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c)
                          if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])
    out.write.mode("overwrite").option("header", True).csv(path)


def write_latest_parquet(df: DataFrame, path: str) -> None:
    """K2: replace the 'latest' Parquet dataset (microsecond timestamps are a
    session setting, see ``session.SEMANTIC_CONF``)."""
    df.write.mode("overwrite").parquet(path)


def append_history(df: DataFrame, path: str, run_ts: datetime, column: str = "run_ts") -> DataFrame:
    """K3: append this run's rows, stamped and partitioned by the UTC run time."""
    stamped = df.withColumn(column, F.lit(run_ts.strftime("%Y%m%d_%H%M%S")))
    stamped.write.mode("append").partitionBy(column).parquet(path)
    return stamped


def append_existing(spark: SparkSession, df: DataFrame, table: str) -> None:
    """K4: append into an existing table only (``CREATE_NEVER``); columns the
    table does not have are ignored, missing ones become null (P8)."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    target = spark.table(table)
    project_to(df, [(f.name, f.dataType.simpleString()) for f in target.schema.fields]) \
        .write.insertInto(table, overwrite=False)


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = (),
                  location: str | None = None) -> None:
    """K5 / K7: replace the whole table (``if_exists='replace'`` / CTAS). With
    ``location`` the table's files live there (a shared folder on a cluster)."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if location:
        w = w.option("path", location)
    w.saveAsTable(table)


def create_table_if_missing(spark: SparkSession, table: str, schema_ddl: str,
                            partition_by: Sequence[str] = (), location: str | None = None) -> None:
    """K6: ``CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY (...)``.
    Clustering becomes ``sortWithinPartitions`` at write time (see jobs)."""
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema_ddl}) USING parquet{part}{loc}")


def recreate_dimension_and_fact(dimension: DataFrame, dim_table: str, fact: DataFrame, fact_table: str,
                                foreign_key: tuple[str, str] | None = None, primary_key: Sequence[str] = (),
                                not_null: Sequence[str] = (), max_length: dict[str, int] | None = None,
                                folder: str | None = None) -> None:
    """K8: replaces a dimension and the fact that references it, both or neither.

    Both are written aside, under ``folder`` (the shared folder by default), and the
    constraints are checked on what was written (Q7): a violation raises and the old pair
    stays. Then the old fact goes out of the way first and the old dimension second,
    the new dimension and the new fact take their names, and the old pair is dropped.
    A failure in between puts the old pair back.
    """
    from quarry.operators.quality import constraint_violations
    from quarry.session import shared_path

    spark, tag = dimension.sparkSession, uuid.uuid4().hex[:12]
    base = folder or shared_path(spark, "tables")
    paths = {t: f"{base}/{t.replace('.', '_')}-{tag}" for t in (dim_table, fact_table)}
    dimension.write.parquet(paths[dim_table])
    fact.write.parquet(paths[fact_table])
    new_dim, new_fact = (spark.read.parquet(paths[t]) for t in (dim_table, fact_table))
    if foreign_key or primary_key or not_null or max_length:
        report = constraint_violations(
            new_fact, primary_key=primary_key, not_null=not_null, max_length=max_length,
            foreign_keys=[(foreign_key[0], new_dim, foreign_key[1])] if foreign_key else [])
        bad = report.filter("violations > 0").collect()  # one row a constraint
        if bad:
            raise ValueError("constraints violated: " + ", ".join(
                f"{r['check']}({r['column_name']})={r['violations']}" for r in bad))
    aside, made = {}, []
    try:
        for t in (fact_table, dim_table):
            if spark.catalog.tableExists(t):
                spark.sql(f"ALTER TABLE {t} RENAME TO {t}__old_{tag}")
                aside[t] = f"{t}__old_{tag}"
        for t in (dim_table, fact_table):
            spark.catalog.createTable(t, path=paths[t], source="parquet")
            made.append(t)
    except Exception:
        for t in made:
            spark.sql(f"DROP TABLE {t}")
        for t, old in reversed(aside.items()):
            spark.sql(f"ALTER TABLE {old} RENAME TO {t}")
        raise
    for old in aside.values():
        spark.sql(f"DROP TABLE {old}")


def append_batched(df: DataFrame, table: str | None = None, jdbc_url: str | None = None,
                   batch_size: int = 500, properties: dict | None = None) -> None:
    """K9: batched append with a fixed field order. To a JDBC target the batch
    size is the driver's ``batchsize``; to a catalog table Spark writes files."""
    if jdbc_url:
        (df.write.mode("append").option("batchsize", batch_size)
         .jdbc(jdbc_url, table, properties=properties or {}))
    else:
        target = df.sparkSession.table(table).columns  # insertInto goes by position
        df.select(*target).write.mode("append").insertInto(table)


def clear_dataset(spark: SparkSession, df_schema_source: DataFrame, path: str) -> None:
    """Empty the landing dataset, keeping its schema."""
    spark.createDataFrame([], df_schema_source.schema).write.mode("overwrite").parquet(path)
