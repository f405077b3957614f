"""Session helpers for tests, the bench and scripts.

On a cluster the caller owns the session; library code only reads settings
from it.  ``checkpoint_dir`` returns the shared folder the cluster names in
``spark.checkpoint.dir`` and sets a scratch one only when none is configured
(local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "skymetrics") -> SparkSession:
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or max(2, n)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # local data is small: let AQE keep post-shuffle stages spread over all
        # cores instead of merging them into 1 MB partitions (cluster runs keep
        # the advisory size, see README)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # local disk without the native Hadoop library: a parallel listing job
        # serialises full file statuses, which forks a process per file here;
        # listing on the driver avoids that (clusters keep the default)
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
        # local scratch files only: no .crc side file per written file (each
        # created file costs a forked chmod here); cluster file systems keep
        # their own integrity checks
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SKYMETRICS_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession, required: bool = True) -> str | None:
    """The shared folder for checkpoints and written intermediate tables.

    Uses the context's checkpoint directory, else ``spark.checkpoint.dir``.  A
    scratch folder is created only for a local-mode session (tests); on a
    cluster a machine-local folder would be wrong, so without the setting this
    raises (or returns None when ``required`` is false).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            if required:
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            return None
        configured = tempfile.mkdtemp(prefix="skymetrics-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
