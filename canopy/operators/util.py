"""Small shared helpers: materialization and output formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.session import scratch_path

TS_PATTERN = "yyyy-MM-dd HH:mm:ss"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder named by
    ``spark.checkpoint.dir`` and read it back: the lineage is cut, the data
    survives the loss of any executor, later reads prune columns, and the
    planner sees the real size.

    Used where one expensive frame feeds several branches (corpora, model
    tables, sweep) or an iterative loop.  RDD ``checkpoint()`` was measured
    too: slightly faster on small stages, but every checkpointed stage kept
    tens of MB on the driver heap, which an iterative job (components,
    cluster hierarchy) cannot afford; ``localCheckpoint`` is never used.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    stored.stage_path = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete the table behind a frame that ``materialize`` returned, once
    nothing reads it any more (through Hadoop's file system, so any store works)."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored.stage_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now: it does so once the driver's collector finds that
    nothing refers to them, which in a large heap is long after the tables made of them are written."""
    spark._jvm.System.gc()


def ts_string(col) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss`` text (stable across engines)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, TS_PATTERN)


def round_to(col, places: int = 6) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double"), places)
