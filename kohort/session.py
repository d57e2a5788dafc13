"""Spark session set-up shared by the library, tests and the bench.

The library never builds a session inside an operator: operators take
DataFrames.  This module only helps callers (tests, bench, the batch job)
get a session with the settings the operators assume, and resolves the
checkpoint directory used to cut lineage.
"""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings every query relies on.  They can be set on an
# existing session (the driver passes its own), so they are applied by
# ``configure`` rather than only at build time.
RUNTIME_CONF = {
    # F7 (timestamps read as UTC): dates are derived from TIMESTAMP_NTZ
    # columns; pin UTC anyway so any timestamp-with-zone expression behaves
    # the same on every executor
    "spark.sql.session.timeZone": "UTC",
    # AQE: coalesce small shuffle partitions, split skewed join partitions,
    # and turn a sort-merge join into a broadcast join when the runtime size
    # of one side is under the broadcast threshold
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system and is used as is;
    a cluster session without it is an error (a machine-local folder would
    not survive the loss of the executor that wrote it).  Only a local-mode
    session without the setting (tests, local runs) gets a scratch folder,
    so lineage can still be cut with ``DataFrame.checkpoint``.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a shared folder "
                             "(HDFS, object store) for checkpoints on a cluster")
        path = tempfile.mkdtemp(prefix="kohort-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def get_session(master: str | None = None, app: str = "kohort",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    ``master`` defaults to ``$KOHORT_MASTER`` and then to Spark's own default,
    so on a cluster the submitter decides.  The web UI stays off.
    """
    builder = SparkSession.builder.appName(app)
    master = master or os.environ.get("KOHORT_MASTER")
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    # checkpoint files of DataFrames that are no longer referenced are removed
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


# Target bytes per shuffle partition and per scan split on a cluster
PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the input files (file-system metadata, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            total += fs.getContentSummary(hp).getLength()
    return int(total)


def size_for_input(spark: SparkSession, total_bytes: int,
                   partition_bytes: int = PARTITION_BYTES) -> dict:
    """Size shuffles and scans for ``total_bytes`` of input.

    Initial shuffle partitions = input / 256 MB (at least the default
    parallelism), so a shuffle of the full input spills little per task;
    AQE then coalesces small ones to the same advisory size and splits
    skewed ones.  Scan splits are 256 MB.  Returns the settings applied.
    """
    cores = spark.sparkContext.defaultParallelism
    parts = max(cores, math.ceil(total_bytes / partition_bytes))
    settings = {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    return settings
