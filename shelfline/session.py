"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC dates, ANSI arithmetic, AQE re-planning,
# dynamic partition overwrite for day loads.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a join whose smaller side makes small partitions hashes these instead of sorting both sides
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # folders of partitioned tables are listed by so many tasks, not by one task each
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # plans name whole paths, however long the lake's root is
    "spark.sql.maxMetadataStringLength": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove RDD checkpoint files once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Settings for a large cluster (hundreds of executors, tens of TB per day):
# many initial shuffle partitions that AQE coalesces to ~256 MB each, skewed
# partitions split, input splits of 256 MB, and a broadcast limit that keeps a
# broadcast side small enough to ship to every executor.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "256m",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "1000",
    "spark.sql.files.maxRecordsPerFile": "20000000",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "shelfline", cluster: bool = False,
                checkpoint_dir: str | None = None) -> SparkSession:
    """A session with this library's settings; ``checkpoint_dir`` is for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if cluster:
        for k, v in CLUSTER_CONF.items():
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if checkpoint_dir and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to a session built elsewhere (e.g. the driver's)."""
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint directory.

    The cluster names it in ``spark.checkpoint.dir``; tests and tools set their own
    before.  A machine-local default would scatter files over the executors, so an
    unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique directory under the shared checkpoint folder.

    Queries that must write (landing, day loads, upserts) put their lake here, so
    that every executor sees the same files.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lake-{name}-{uuid.uuid4().hex[:12]}"
