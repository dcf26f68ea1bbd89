"""Session helpers for tests, the bench and scripts.

The library itself never creates a session: every function takes DataFrames.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "starmart") -> SparkSession:
    """A local session configured like the cluster one (UTC, AQE, no UI).

    ``spark.checkpoint.dir`` is taken from the environment's Spark defaults;
    only when nothing sets it is a scratch folder created for this process.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STARMART_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Where none is set, a local session
    (one machine, as in tests) gets a scratch one; on a cluster that is an error,
    because executors would each write to a disk of their own."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured and not (spark.sparkContext.master + "[").startswith("local["):
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set: point it at a folder every executor can reach")
    if not configured:
        configured = tempfile.mkdtemp(prefix="starmart-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()
