"""Session helpers: a local session for tests/bench and the shared scratch root."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "orderstream", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session with the settings the tests and bench rely on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ORDERSTREAM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only a local
    session without one gets a fresh private folder; a cluster session without
    the setting is an error, since a machine-local folder would not survive the
    loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote client session: only the configuration is visible
        sc = None
    root = (sc.getCheckpointDir() if sc else None) or spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        if sc and not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    master = sc.master if sc else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder the executors can reach")
    root = tempfile.mkdtemp(prefix="orderstream-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, root)
    if sc:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
