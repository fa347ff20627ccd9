"""Session helpers.

The library never builds its own cluster settings into the analyses: every
operator takes DataFrames and returns DataFrames.  These helpers exist for
tests, the bench and command-line runs on one machine.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "rankwise") -> SparkSession:
    """A local session with AQE on and the web UI off."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        # one JVM holds every task: waiting for a "better" locality level
        # only idles slots (measured ~18% on the bench subset)
        .config("spark.locality.wait", "0s")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is left alone (and
    must be set).  Only in local mode with no setting (tests, a laptop) a
    fresh local folder is chosen.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        # a machine-local folder would not survive an executor loss
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    path = tempfile.mkdtemp(prefix="rankwise-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for a written table."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
