"""Shapes of the reference pipelines' inputs derived from the driver tables.

The driver tables are TPC-H-like plus an ``events`` stream; the pipelines read
station snapshots, book indexes, country series, inventory and sales. Each view
below re-labels driver columns into one of those shapes (all rows, every run),
so the operators run on data that grows with the tables. Every view has a twin
SQL text for the DuckDB oracle in ``checks.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("long")


def station_status(events: DataFrame) -> DataFrame:
    """Events as station snapshots: user = station (user 7 has a null id, to
    exercise null keys), hour of ``ts`` = status timestamp, ``ts`` = snapshot
    time; a purchase is a free bike, an error a station with no empty slot."""
    k = _k()
    return events.select(
        F.nullif(F.col("user_id").cast("string"), F.lit("7")).alias("station_id"),
        F.concat(F.lit("net-"), F.pmod(F.col("user_id"), F.lit(4)).cast("string")).alias("network_id"),
        F.lit("events").alias("network_name"),
        (F.lit(40.5) + F.col("user_id").cast("double") / F.lit(1000.0)).alias("latitude"),
        (F.lit(-74.0) - F.col("user_id").cast("double") / F.lit(1000.0)).alias("longitude"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("timestamp"),
        F.when(F.col("event_type") == "purchase", F.floor("value").cast("long"))
        .otherwise(F.lit(0).cast("long")).alias("free_bikes"),
        F.when(F.col("event_type") == "error", F.lit(0).cast("long")).otherwise(k).alias("empty_slots"),
        F.col("event_id").cast("string").alias("extra_uid"),
        (F.col("event_type") != "error").alias("renting"),
        (F.col("value") > 10).alias("returning"),
        (k > 50).alias("has_ebikes"),
        F.pmod(k, F.lit(7)).alias("ebikes"),
        F.col("ts").alias("snapshot_time"),
        F.col("event_type"),
    )


STATION_STATUS_SQL = """
  SELECT nullif(CAST(user_id AS VARCHAR), '7') AS station_id,
         'net-' || CAST(user_id % 4 AS VARCHAR) AS network_id,
         'events' AS network_name,
         CAST(40.5 AS DOUBLE) + CAST(user_id AS DOUBLE) / CAST(1000 AS DOUBLE) AS latitude,
         CAST(-74.0 AS DOUBLE) - CAST(user_id AS DOUBLE) / CAST(1000 AS DOUBLE) AS longitude,
         date_trunc('hour', ts) AS "timestamp",
         CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS free_bikes,
         CASE WHEN event_type = 'error' THEN CAST(0 AS BIGINT)
              ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS empty_slots,
         CAST(event_id AS VARCHAR) AS extra_uid,
         event_type <> 'error' AS renting,
         value > 10 AS returning,
         CAST(json_extract_string(props, '$.k') AS BIGINT) > 50 AS has_ebikes,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 AS ebikes,
         ts AS snapshot_time,
         event_type
  FROM events
"""
