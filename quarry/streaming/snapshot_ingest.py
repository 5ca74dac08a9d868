"""ST1: incremental snapshot ingest with Structured Streaming.

New snapshot documents landed in a folder -> flat typed silver -> newest-wins
upsert into a date-partitioned master table, one micro-batch at a time.

* The file source's checkpoint remembers which files were processed (S9), so a
  rerun with no new files does nothing.
* Each micro-batch is merged with ``version_col='snapshot_time'`` kept on the
  master, so landing files out of order leaves the same table (late data needs no
  watermark).
* The batch's number is entered in the table's ledger together with its rows, so a
  batch that is replayed after a failure is left out as a whole: rows with null
  station ids, which match nothing, are not inserted twice either.
* ``trigger(availableNow=True)`` processes what is there and stops, which is how
  a scheduled weekly run uses it; a continuous trigger works unchanged.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from quarry.operators.upsert import upsert_into_table
from quarry.plans import bike
from quarry.session import shared_path
from quarry.sinks.tables import create_table_if_missing

# Landed file names carry the snapshot time: ``station_status_YYYY-mm-dd_HH-MM-SS.json``.
FILE_TIME_RE = r"(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})"
FILE_TIME_FMT = "yyyy-MM-dd_HH-mm-ss"

# Landed documents may carry their own snapshot time (a top-level text field).
STREAM_SCHEMA = StructType([*bike.SNAPSHOT_SCHEMA.fields, StructField("snapshot_time", StringType())])

MASTER_DDL = ", ".join(f"{n} {t}" for n, t in bike.MASTER_FIELDS) + ", snapshot_time timestamp, ts_date date"


def snapshot_time_of_document() -> F.Column:
    """The document's own snapshot time, else the time in the landed file name,
    else the file's modification time."""
    path = F.col("_metadata.file_path")
    from_name = F.try_to_timestamp(F.regexp_extract(path, FILE_TIME_RE, 1), F.lit(FILE_TIME_FMT))
    return F.coalesce(F.try_to_timestamp(F.col("snapshot_time")), from_name,
                      F.col("_metadata.file_modification_time"))


def merge_batch(spark: SparkSession, docs: DataFrame, master_table: str,
                batch_id: tuple[str, int] | None = None) -> dict:
    """One micro-batch: flatten, type, upsert (newest snapshot wins per key), unless the
    table's ledger has it; the upsert keeps the typed batch persisted while it reads it."""
    staging = bike.type_silver(bike.flatten_stations(docs, carry=("snapshot_time",)))
    return upsert_into_table(spark, master_table, staging, bike.MERGE_KEYS, bike.UPDATED_COLUMNS,
                      partition_col="ts_date", partition_expr=F.to_date("timestamp"),
                      order_desc=("snapshot_time",), tiebreak=("extra_uid",),
                      version_col="snapshot_time", cluster_by=("station_id",), batch_id=batch_id)


def stream_name(batch: DataFrame, checkpoint: str) -> str:
    """The running query's own id, which its checkpoint keeps over restarts."""
    name = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return name or hashlib.sha256(checkpoint.encode()).hexdigest()


def start(spark: SparkSession, landing_dir: str, master_table: str,
          checkpoint: str | None = None, available_now: bool = True,
          multi_line: bool = False, max_files_per_trigger: int | None = None,
          table_location: str | None = None) -> StreamingQuery:
    """Start the ingest; returns the running query (``awaitTermination()`` it)."""
    create_table_if_missing(spark, master_table, MASTER_DDL, partition_by=("ts_date",),
                            location=table_location)
    reader = (spark.readStream.schema(STREAM_SCHEMA).option("multiLine", multi_line))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.json(landing_dir).select("network", snapshot_time_of_document().alias("snapshot_time"))
    kept = checkpoint or shared_path(spark, f"stream-{master_table}")
    writer = (docs.writeStream
              .foreachBatch(lambda batch, number: merge_batch(spark, batch, master_table,
                                                              (stream_name(batch, kept), number)))
              .option("checkpointLocation", kept))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def documents_from_status(status: DataFrame) -> DataFrame:
    """One single-station snapshot document per status row, as JSON text (used to
    land test input from table rows; every document holds exactly one station, so
    no rows are ever gathered into one document)."""
    station = F.struct(
        F.col("station_id").alias("id"), F.col("station_id").alias("name"),
        F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.col("free_bikes").cast("string").alias("free_bikes"),
        F.col("empty_slots").cast("string").alias("empty_slots"),
        F.struct(F.col("extra_uid").alias("uid"), F.col("ebikes").cast("string").alias("ebikes"),
                 F.col("has_ebikes").cast("string").alias("has_ebikes"),
                 F.lit("1700000000").alias("last_updated"),
                 F.col("renting").cast("string").alias("renting"),
                 F.col("returning").cast("string").alias("returning")).alias("extra"))
    network = F.struct(F.col("network_id").alias("id"), F.col("network_name").alias("name"),
                       F.lit("http://example.com").alias("href"),
                       F.array(F.lit("operator")).alias("company"),
                       F.struct(F.lit("New York, NY").alias("city"), F.lit("US").alias("country"),
                                F.lit("40.7").alias("latitude"), F.lit("-74.0").alias("longitude"))
                       .alias("location"),
                       F.array(station).alias("stations"))
    snap = F.date_format("snapshot_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("snapshot_time")
    return status.select(F.to_json(F.struct(network.alias("network"), snap)).alias("value"))
