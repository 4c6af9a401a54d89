"""SparkSession helpers.

Library code never builds its own session; callers pass one in. ``local_session``
exists for tests and the bench: it pins UTC (timestamp text and calendar
functions depend on the session zone), keeps AQE on and the UI off, and gives
the session a checkpoint directory only when none is configured.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "faregrid") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # coalesce shuffle output to the advisory size (64 MB) rather than
        # keeping one partition per core: fewer, larger files per partition dir
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", os.environ.get("FAREGRID_ADVISORY_BYTES", "64m"))
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FAREGRID_DRIVER_MEMORY", "16g"))
    )
    if not SparkConf().get(CHECKPOINT_CONF, None):
        # tests and the bench: a fresh scratch folder per run, never reused
        builder = builder.config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="faregrid-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Intermediate tables that cut lineage are written below it, so a lost
    executor never forces recomputation from the raw input. Where it is unset, a
    local master (driver and executors are one process) gets a scratch folder; on
    a cluster that is an error, since executors share no local folder.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or sc.getConf().get(CHECKPOINT_CONF, None)
    if not found and (sc.master == "local" or sc.master.startswith("local[")):
        found = tempfile.mkdtemp(prefix="faregrid-ckpt-")
    if not found:
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set; configure a shared folder for the cluster")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found
