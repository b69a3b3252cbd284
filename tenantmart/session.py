"""Spark session settings and shared-storage helpers.

Every job in the package is a lazy DataFrame plan; this module only decides
how the session is configured and where durable intermediate data lives.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings chosen for the large-cluster target (~100 TB, ~1000 executors);
# local runs override the partition count.
#
# * Shuffle width: the widest shuffle is the labour fact's fan-out (a few TB
#   at that scale); 16384 map-side buckets keep a reducer near the 128 MB
#   advisory size, and AQE coalesces the small shuffles down.
# * Broadcasts are never forced on data-dependent sides: the planner's size
#   estimate decides (the parquet byte count is scaled by 4 to account for
#   compression, so a compressed 8 MB side is seen as 32 MB), AQE re-decides
#   from real shuffle sizes, and a sort-merge join is used beyond.
# * Skewed join partitions are split by AQE; every aggregation is partial
#   before its shuffle.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # batch runs give each tenant a scheduler pool of its own
    "spark.scheduler.mode": "FAIR",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tenantmart", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` is only set when given, so a cluster submit keeps its own.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A folder of our own is set only in ``local`` mode, where driver and
    executors are one process; a cluster without the setting is an error,
    because executors would each write to their own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None)
    if not target:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        target = fallback or tempfile.mkdtemp(prefix="tenantmart-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


#: Spark removes an execution's shuffle files when it ends, not when the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping = {"writers": 0, "before": None}
_dropping_lock = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Writes in this block leave no shuffle files behind; of blocks in several
    threads the last one puts the session's setting back.  A frame that is
    evaluated again shuffles again."""
    with _dropping_lock:
        if _dropping["writers"] == 0:
            _dropping["before"] = spark.conf.get(DROP_SHUFFLES)
            spark.conf.set(DROP_SHUFFLES, "true")
        _dropping["writers"] += 1
    try:
        yield
    finally:
        with _dropping_lock:
            _dropping["writers"] -= 1
            if _dropping["writers"] == 0:
                spark.conf.set(DROP_SHUFFLES, _dropping["before"])


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tenantmart/{purpose}/{uuid.uuid4().hex}"
