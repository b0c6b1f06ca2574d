"""Session helpers: a tuned local session for tests and a shared checkpoint dir."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(cpus: int | str = "*", app: str = "closecast", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session used by tests, the bench and the CLI-style jobs.

    On a cluster the builder defaults come from spark-submit; the settings here
    only matter for ``local[...]`` runs.
    """
    parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("CLOSECAST_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint dir; create a scratch one only if unset in local mode.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is respected
    as-is; without it this raises, because a folder on the driver's disk is not
    seen by the executors. Only a local session gets a fresh scratch dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that every executor of {sc.master} can reach")
    target = configured or tempfile.mkdtemp(prefix="closecast-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target
