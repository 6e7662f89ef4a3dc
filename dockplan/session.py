"""Session helpers: a local session for tests and the bench.

On a cluster the session comes from the platform; nothing here overrides its
settings. Reports and schedules write nothing: a checkpoint folder is only
chosen here for local sessions of tests that ask for one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dockplan") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DOCKPLAN_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, allow_local=True)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The reliable folder configured for this session, if any."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, read the session conf only
        return spark.conf.get("spark.checkpoint.dir", None)
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        sc.setCheckpointDir(d)
    return d


def ensure_checkpoint_dir(spark: SparkSession, allow_local: bool = False) -> str | None:
    """Use the configured folder; only a local run may get a scratch one."""
    d = checkpoint_dir(spark)
    if d is None and allow_local and spark.sparkContext.master.startswith("local"):
        d = tempfile.mkdtemp(prefix="dockplan-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d
