"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings every plan in this package is written for.
#  * UTC: `timestamp -> date` must not depend on where a job runs.
#  * AQE with forced skew handling: a hot join key is split over several tasks even where the
#    split costs a further shuffle for the operator that follows.
#  * Shuffles are cut finely and adaptive execution puts small parts together again, so that a part fits a task's memory
#    and sorts do not spill, however large the input. A session that asks for more partitions keeps them.
#  * Tables are read in small pieces. Rows of one piece are sorted or grouped before they are shuffled (group limits of keyed
#    upserts, partial aggregates); a piece of the usual 128 MB holds millions of rows, which spills several times what it sends.
#    Likewise behind a shuffle: its parts are compressed and take several times their size when they are sorted. A session
#    that asks for smaller pieces or parts keeps them.
#  * Broadcasts are never hinted in this package. Spark broadcasts a side only below a size limit:
#    the cluster's own limit for sizes estimated before the run, the one here for sizes measured
#    during it. Above them it sort-merges. Sizes before the run come from compressed files; the
#    compression factor keeps a table that is small only on disk from being broadcast.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "480",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.fileCompressionFactor": "5.0",
}
_PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_AT_MOST = {"spark.sql.files.maxPartitionBytes": 8 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 << 20}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if parts > int(_RUNTIME[_PARTS]):
        spark.conf.set(_PARTS, parts)
    for key, most in _AT_MOST.items():
        if _bytes(spark, spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    return spark


def _bytes(spark: SparkSession, size: str) -> int:
    """A size as Spark writes it (8388608, 8m, 8MB) in bytes."""
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size))


def build_session(app: str = "millrace", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_RUNTIME, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that all executors share.

    It lies under the checkpoint folder the cluster names; where none is named, under the warehouse. On a cluster a
    warehouse on the driver's own disk is no shared folder, and there is no scratch folder then.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        alone = spark.sparkContext.master.split("[")[0] == "local"
        if not alone and (warehouse.startswith("file:") or "://" not in warehouse):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"{warehouse}/_scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
