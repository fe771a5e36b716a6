"""Session helpers: defaults the pipeline relies on, and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline needs for deterministic, scale-friendly plans. They are applied
# only where the session does not set them already, so a cluster's own tuning wins.
PIPELINE_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Listings of thousands of folders (days x channels) go in so many tasks, not one for each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    # Streaming state (redelivery dedup: a day of keys; live counts) lives in RocksDB on the
    # executors' local disks with changelog checkpoints, not on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Defaults of Spark that answer for settings nobody made.
UNSET = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": "10000"}


def build_session(app_name: str = "slotflow", cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark (a cluster passes its own session in)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply PIPELINE_DEFAULTS where unset, except the time zone, which is always UTC:
    every timestamp the pipeline parses or derives (dates, hours, weekdays) is defined in UTC."""
    for key, value in PIPELINE_DEFAULTS.items():
        if key == "spark.sql.session.timeZone":
            spark.conf.set(key, value)
        elif spark.conf.get(key, None) is None or (key in UNSET and spark.conf.get(key) == UNSET[key]):
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A deployment sets it to a shared file system. Where it is unset a local master (tests) gets
    a folder of its own; on a cluster that is an error, since one machine's disk is no shared
    folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not re.match(r"local(\[[^-]*)?$", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {master}")
        path = tempfile.mkdtemp(prefix="slotflow-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub folder of the checkpoint folder for staged tables (lineage cuts)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/slotflow-stage/{name}-{uuid.uuid4().hex}"
