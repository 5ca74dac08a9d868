"""SparkSession construction and the few session-level settings every job relies on.

The settings here replace choices the pipelines made by hand: UTC everywhere,
microsecond Parquet timestamps, dynamic partition overwrite for upserts, and AQE
(partition coalescing + skew-join splitting) so one hot key does not pin a task.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a job needs for correct results, independent of cluster size.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Settings for throughput at scale; AQE re-plans joins/aggregations at runtime.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Only tables whose size Spark can prove are auto-broadcast; 32 MB is the ceiling.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# AQE can merge small shuffle partitions but never splits a large one (apart from
# skewed join partitions), so a cluster session starts from many partitions and
# lets AQE coalesce them to the advisory size. 16384 x 128 MB covers a 2 TB
# shuffle stage; size bigger ones with ``shuffle_partitions_for``.
CLUSTER_INITIAL_PARTITIONS = 16384
ADVISORY_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(shuffle_bytes: int, partition_bytes: int = ADVISORY_PARTITION_BYTES) -> int:
    """Shuffle partitions that keep each reduce task near ``partition_bytes``."""
    return max(1, -(-shuffle_bytes // partition_bytes))


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings applied.

    On a cluster, leave ``master`` as None so spark-submit decides; tests pass
    ``local[*]`` and a small ``shuffle_partitions``. Without an explicit count the
    session starts shuffles at ``CLUSTER_INITIAL_PARTITIONS`` and AQE coalesces
    them to ~128 MB each.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_CONF, **SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                                 str(CLUSTER_INITIAL_PARTITIONS))
    spark = builder.getOrCreate()
    apply_semantics(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_semantics(spark: SparkSession) -> None:
    """Apply the result-affecting settings to an existing session (e.g. the driver's)."""
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A directory of our own is set only when the cluster names none (local tests).
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")  # one machine: its disk is shared
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
