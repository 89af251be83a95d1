"""Session construction and the shared scratch / checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "canopy",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE on, UTC session time and Arrow transfer enabled.

    On a cluster pass ``master=None`` and let spark-submit decide, also on the
    shuffle partitions (sized so that one stays at 128-256 MB).  On a local
    master they default to twice the cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = max(8, 2 * (os.cpu_count() or 8))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CANOPY_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  Only when nothing is configured *and* the master is
    local (tests, single-node runs) do we create a scratch folder; on a
    cluster an unset value is an error because a machine-local folder is
    not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS)")
        root = tempfile.mkdtemp(prefix="canopy-ckpt-", dir="/tmp")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh sub-path under the shared checkpoint root for a written table."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
