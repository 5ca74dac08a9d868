"""Station-status lake: nested snapshot documents -> validated bronze -> flat typed
silver -> keyed upsert into master -> weekly utilisation gold.

Spark shape: read.json -> Q1 -> X1/X2 -> C2-C4,C7 -> F6 -> W1 -> K11 -> F7 -> A5 -> K7.
Shuffles only at the dedup (partial max_by), the merge join and the gold group-by.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from quarry.functions.scalars import (coerce_numeric, fill_defaults, parse_timestamp_utc,
                                      to_bool_default_false)
from quarry.operators.aggregates import utilization_states, weekly_utilization
from quarry.operators.documents import Either, Flag, Many, Num, Rec, Text, assert_documents, judged, read_documents
from quarry.operators.filters import in_range, rolling_days
from quarry.operators.quality import Rule
from quarry.operators.upsert import merge_upsert
from quarry.sinks import swap
from quarry.sinks.tables import create_table_if_missing

# Read every leaf that may hold a number, text or boolean as text: a JSON number
# under a string field becomes its text, a JSON 1 under a boolean field would
# silently become null.
EXTRA_SCHEMA = StructType([
    StructField("uid", StringType()), StructField("ebikes", StringType()),
    StructField("has_ebikes", StringType()), StructField("last_updated", StringType()),
    StructField("renting", StringType()), StructField("returning", StringType()),
])
STATION_SCHEMA = StructType([
    StructField("id", StringType()), StructField("name", StringType()),
    StructField("latitude", StringType()), StructField("longitude", StringType()),
    StructField("timestamp", StringType()), StructField("free_bikes", StringType()),
    StructField("empty_slots", StringType()), StructField("extra", EXTRA_SCHEMA),
])
SNAPSHOT_SCHEMA = StructType([StructField("network", StructType([
    StructField("id", StringType()), StructField("name", StringType()),
    StructField("href", StringType()), StructField("company", ArrayType(StringType())),
    StructField("location", StructType([
        StructField("city", StringType()), StructField("country", StringType()),
        StructField("latitude", StringType()), StructField("longitude", StringType())])),
    StructField("stations", ArrayType(STATION_SCHEMA)),
]))])

# Staging / master layouts (master = staging without snapshot_time).
MASTER_FIELDS = [
    ("network_id", "string"), ("network_name", "string"), ("station_id", "string"),
    ("latitude", "double"), ("longitude", "double"), ("timestamp", "timestamp"),
    ("free_bikes", "bigint"), ("empty_slots", "bigint"), ("extra_uid", "string"),
    ("renting", "boolean"), ("returning", "boolean"), ("has_ebikes", "boolean"),
    ("ebikes", "bigint"),
]
MASTER_COLUMNS = [n for n, _ in MASTER_FIELDS]
MERGE_KEYS = ("station_id", "timestamp")
# Fixed value: the six columns a matched master row takes from the newer snapshot.
UPDATED_COLUMNS = ("free_bikes", "empty_slots", "ebikes", "renting", "returning", "has_ebikes")

# Validation bounds of the snapshot documents.
LAT_RANGE = (40.4, 40.9)
LON_RANGE = (-74.3, -73.7)
MIN_EPOCH = 1_000_000_000
UID_HEX36 = r"^[a-f0-9\-]{36}$"
UID_DIGITS = r"^[0-9]+$"
CITY_RE = r"^New York(,? ?NY)?$"
COUNTRY_RE = r"^US$"
NETWORK_ID_RE = r"^citi-bike-nyc$"
NETWORK_NAME_RE = r"Citi Bike"

# What a landed snapshot must look like. ``format`` keywords are not enforced,
# as in the source.
EXTRA_SHAPE = Rec({"ebikes": Num(least=0), "has_ebikes": Flag(), "last_updated": Num(least=MIN_EPOCH),
                   "uid": Either((Num(least=1), Text(UID_HEX36), Text(UID_DIGITS)))})
STATION_SHAPE = Rec(
    {"empty_slots": Num(least=0), "free_bikes": Num(least=0), "id": Text(shortest=1), "latitude": Num(*LAT_RANGE),
     "longitude": Num(*LON_RANGE), "name": Text(shortest=1)},
    optional={"extra": EXTRA_SHAPE, "timestamp": Text()})
LOCATION_SHAPE = Rec({"city": Text(CITY_RE), "country": Text(COUNTRY_RE), "latitude": Num(*LAT_RANGE),
                      "longitude": Num(*LON_RANGE)})
SNAPSHOT_SHAPE = Rec({"network": Rec(
    {"company": Many(Text(), fewest=1), "href": Text(), "id": Text(NETWORK_ID_RE), "location": LOCATION_SHAPE,
     "name": Text(NETWORK_NAME_RE), "stations": Many(STATION_SHAPE, fewest=1)})})

# Null defaults of the silver layer (H-7: missing counts become 0).
SILVER_DEFAULTS = {"free_bikes": 0, "empty_slots": 0, "ebikes": 0, "latitude": 0.0, "longitude": 0.0}


def _num(c):
    return F.col(c).try_cast("double") if isinstance(c, str) else c.try_cast("double")


def _outside(c, lo, hi):
    v = _num(c)
    return v.isNull() | (v < F.lit(lo)) | (v > F.lit(hi))


def _negative_or_bad(c):
    v = _num(c)
    return v.isNull() | (v < F.lit(0))


def document_rules() -> list[Rule]:
    """Q1 rules on the network part of each document (one row per document)."""
    n = F.col("network")
    loc = n["location"]
    return [
        ("network.required", n.isNull()),
        ("network.id", ~F.coalesce(n["id"].rlike(NETWORK_ID_RE), F.lit(False))),
        ("network.name", ~F.coalesce(n["name"].rlike(NETWORK_NAME_RE), F.lit(False))),
        ("network.href", n["href"].isNull()),
        ("network.company", F.coalesce(F.size(n["company"]), F.lit(0)) < 1),
        ("location.city", ~F.coalesce(loc["city"].rlike(CITY_RE), F.lit(False))),
        ("location.country", ~F.coalesce(loc["country"].rlike(COUNTRY_RE), F.lit(False))),
        ("location.latitude", _outside(loc["latitude"], *LAT_RANGE)),
        ("location.longitude", _outside(loc["longitude"], *LON_RANGE)),
        ("network.stations", F.coalesce(F.size(n["stations"]), F.lit(0)) < 1),
    ]


def station_rules(st: str = "st") -> list[Rule]:
    """Q1 rules on each station (one row per station). ``timestamp`` and ``extra``
    are optional; ``format`` keywords are not enforced, as in the source."""
    s = F.col(st)
    e = s["extra"]
    uid = e["uid"]
    uid_ok = (F.coalesce(_num(uid) >= F.lit(1), F.lit(False))
              | F.coalesce(uid.rlike(UID_HEX36), F.lit(False))
              | F.coalesce(uid.rlike(UID_DIGITS), F.lit(False)))
    has_extra = e.isNotNull()
    return [
        ("station.empty_slots", _negative_or_bad(s["empty_slots"])),
        ("station.free_bikes", _negative_or_bad(s["free_bikes"])),
        ("station.id", F.coalesce(F.length(s["id"]), F.lit(0)) < 1),
        ("station.name", F.coalesce(F.length(s["name"]), F.lit(0)) < 1),
        ("station.latitude", _outside(s["latitude"], *LAT_RANGE)),
        ("station.longitude", _outside(s["longitude"], *LON_RANGE)),
        ("extra.ebikes", has_extra & _negative_or_bad(e["ebikes"])),
        ("extra.has_ebikes", has_extra & ~F.coalesce(F.lower(e["has_ebikes"]).isin("true", "false"),
                                                     F.lit(False))),
        ("extra.last_updated", has_extra & (F.coalesce(_num(e["last_updated"]), F.lit(0.0))
                                            < F.lit(float(MIN_EPOCH)))),
        ("extra.uid", has_extra & ~uid_ok),
    ]


def flatten_stations(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """X1 + X2: one row per station carrying the network fields (and ``carry``
    columns of the document); ``extra`` may be absent (null-propagating access)."""
    st = docs.select(*carry, F.col("network.id").alias("network_id"),
                     F.col("network.name").alias("network_name"),
                     F.explode("network.stations").alias("st"))
    return st.select(
        *carry, "network_id", "network_name",
        F.col("st.id").alias("station_id"), F.col("st.latitude").alias("latitude"),
        F.col("st.longitude").alias("longitude"), F.col("st.timestamp").alias("timestamp"),
        F.col("st.free_bikes").alias("free_bikes"), F.col("st.empty_slots").alias("empty_slots"),
        F.col("st.extra.uid").alias("extra_uid"), F.col("st.extra.renting").alias("renting"),
        F.col("st.extra.returning").alias("returning"),
        F.col("st.extra.has_ebikes").alias("has_ebikes"), F.col("st.extra.ebikes").alias("ebikes"))


def type_silver(flat: DataFrame, snapshot_time: datetime | None = None) -> DataFrame:
    """Typed silver rows for one snapshot run. Without a run
    time, a ``snapshot_time`` column carried from the document is kept."""
    typed = flat.select(
        "network_id", "network_name", "station_id",
        coerce_numeric("latitude").alias("latitude"),
        coerce_numeric("longitude").alias("longitude"),
        parse_timestamp_utc("timestamp").alias("timestamp"),
        coerce_numeric("free_bikes", "double").try_cast("bigint").alias("free_bikes"),
        coerce_numeric("empty_slots", "double").try_cast("bigint").alias("empty_slots"),
        "extra_uid",
        to_bool_default_false("renting").alias("renting"),
        to_bool_default_false("returning").alias("returning"),
        to_bool_default_false("has_ebikes").alias("has_ebikes"),
        coerce_numeric("ebikes", "double").try_cast("bigint").alias("ebikes"),
        *([] if snapshot_time is not None else [F.col("snapshot_time").cast("timestamp")]),
    )
    typed = in_range(typed, "timestamp", F.lit("2000-01-01").cast("timestamp"),
                     F.lit("2100-01-01").cast("timestamp"))
    typed = fill_defaults(typed, SILVER_DEFAULTS)
    if snapshot_time is None:
        return typed
    return typed.withColumn("snapshot_time", F.lit(snapshot_time).cast("timestamp"))


def gate(docs: DataFrame, quarantine: bool = False) -> DataFrame:
    """Q1: the typed snapshots of ``read_documents`` rows that fit ``SNAPSHOT_SHAPE``, network,
    location and every station. A document that doesn't fails the batch; with ``quarantine`` it
    is left out as a whole (:func:`rejected` lists those)."""
    tagged = judged(docs, SNAPSHOT_SHAPE)
    if quarantine:
        tagged = tagged.filter(F.size("violations") == 0)
    else:
        assert_documents(tagged, SNAPSHOT_SHAPE)
    return tagged.select(F.from_json("value", SNAPSHOT_SCHEMA).alias("d")).select("d.*")


def rejected(docs: DataFrame) -> DataFrame:
    """Q1: (value, violations) of the documents that the gate leaves out."""
    return judged(docs, SNAPSHOT_SHAPE).filter(F.size("violations") > 0).select("value", "violations")


def silver_from_documents(docs: DataFrame, snapshot_time: datetime) -> DataFrame:
    return type_silver(flatten_stations(docs), snapshot_time)


def merge_master(master: DataFrame, staging: DataFrame) -> DataFrame:
    """K11 + W1 + J3: newest snapshot per (station, timestamp) upserted into master."""
    return merge_upsert(master.select(*MASTER_COLUMNS), staging, MERGE_KEYS, UPDATED_COLUMNS,
                        order_desc=("snapshot_time",), drop_from_source=("snapshot_time",))


def gold_weekly(master: DataFrame, as_of=None, days: int | None = 7,
                threshold: float = 0.8) -> DataFrame:
    """F7 + D1 + A4 + A5: utilisation per station and Monday week over the last
    ``days`` days before ``as_of`` (``days=None`` -> whole history)."""
    src = master
    if days is not None:
        src = rolling_days(src, "timestamp", days, as_of)
        if "ts_date" in master.columns:  # partition pruning: Spark won't derive it from timestamp
            src = rolling_days(src, "ts_date", days, as_of)
    return weekly_utilization(src, threshold)


def refresh_states(spark: SparkSession, master_table: str, states_table: str, days: DataFrame,
                   location: str | None = None) -> None:
    """A5: recomputes the daily states of the ``days`` (one date column) that a batch touched, from
    those partitions of the master alone; all other days stay."""
    touched = [r[0] for r in days.distinct().collect()]  # one value a day of the batch
    states = utilization_states(spark.table(master_table).filter(F.col("ts_date").isin(touched)))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in states.schema.fields if f.name != "day") + ", day date"
    create_table_if_missing(spark, states_table, ddl, partition_by=("day",), location=location)
    (states.select(*spark.table(states_table).columns).repartition("day").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(swap.location(spark, states_table)))
    spark.sql(f"MSCK REPAIR TABLE {states_table} ADD PARTITIONS")
    spark.catalog.refreshTable(states_table)


def run(spark: SparkSession, raw_path: str, master_table: str, gold_table: str,
        snapshot_time: datetime, as_of=None, quarantine: bool = False,
        latest_only: bool = False, silver_dir: str | None = None,
        multi_line: bool = False) -> DataFrame:
    """End-to-end run for one landed batch of snapshot documents.

    ``latest_only``: ``raw_path`` is the landing folder and only its newest file
    is processed (S3). ``silver_dir``: the typed snapshot is also written as the
    'latest' dataset (K2) and appended to a run-stamped history (K3).
    """
    from quarry.operators.upsert import upsert_into_table
    from quarry.sinks.tables import append_history, replace_table, write_latest_parquet
    from quarry.sources.files import latest_file

    source = latest_file(spark, raw_path, ".json") if latest_only else raw_path
    docs = gate(read_documents(spark, source, multi_line), quarantine)
    staging = silver_from_documents(docs, snapshot_time)
    if silver_dir:
        write_latest_parquet(staging, f"{silver_dir}/latest")
        append_history(staging, f"{silver_dir}/history", snapshot_time)
        staging = spark.read.parquet(f"{silver_dir}/latest")
    ddl = ", ".join(f"{n} {t}" for n, t in MASTER_FIELDS) + ", ts_date date"
    create_table_if_missing(spark, master_table, ddl, partition_by=("ts_date",))
    upsert_into_table(spark, master_table, staging, MERGE_KEYS, UPDATED_COLUMNS,
                      partition_col="ts_date", partition_expr=F.to_date("timestamp"),
                      order_desc=("snapshot_time",), drop_from_source=("snapshot_time",),
                      cluster_by=("station_id",))
    gold = gold_weekly(spark.table(master_table), as_of)
    replace_table(gold, gold_table)
    return spark.table(gold_table)
