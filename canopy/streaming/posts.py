"""Structured Streaming ingest of posts (ST1-ST4).

Posts land as Parquet files in a folder (the collector's output).  The
stream reads them with a declared schema, classifies the URL, joins the
(static) download status and writes every micro-batch idempotently to
``sink/batch_id=N`` (a retried batch overwrites its own folder).  A replayed
post is recognised by a state of post ids without a watermark, so no post is
too late and none is dropped for its age; the state lies in RocksDB, so a
batch costs what it brings and not what the sink holds.  A second query keeps a
per-subreddit running count in state.  Both checkpoint to the shared
folder, so a restart resumes where the last committed batch ended.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canopy.functions import media as M

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

POST_SCHEMA = T.StructType([
    T.StructField("subreddit", T.StringType()),
    T.StructField("post_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("created_utc", T.LongType()),
    T.StructField("author_name", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("flair", T.StringType()),
])


def land(posts: DataFrame, path: str, n_flushes: int = 4) -> str:
    """Land posts the way a collector does, as at least ``n_flushes`` files in
    one write; a flush holds the posts of an hour slot, in no order of age."""
    typed = posts.select(*[F.col(f.name).cast(f.dataType) for f in POST_SCHEMA])
    slot = F.pmod(F.floor(F.col("created_utc") / 3600), F.lit(n_flushes))
    typed.repartition(n_flushes, slot).write.mode("append").parquet(path)
    return path


def read_stream(spark: SparkSession, landing: str, files_per_trigger: int = 1) -> DataFrame:
    """ST1: schema'd file source; the trigger size caps a micro-batch."""
    return (spark.readStream.schema(POST_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(landing))


def classify(stream: DataFrame, status: DataFrame) -> DataFrame:
    """ST3: the batch expressions of P4/P16/P17 plus the static status join."""
    s = stream.select(
        "subreddit", "post_id", "created_utc",
        F.coalesce("author_name", F.lit(M.DELETED_AUTHOR)).alias("author"),
        "url", M.is_image_url("url").alias("is_image"), M.is_gallery_url("url").alias("is_gallery"))
    return s.join(status, "post_id", "left")


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB (on the executors'
    disks, with changes in the checkpoint folder) and not on the heap."""
    before = spark.conf.get(STATE_PROVIDER, None)
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_PROVIDER)
        else:
            spark.conf.set(STATE_PROVIDER, before)


def run_ingest(spark: SparkSession, landing: str, sink: str, checkpoint: str, status: DataFrame) -> None:
    """ST1-ST4: run to completion (``availableNow``) with an idempotent
    per-batch sink; a post that an earlier batch holds is not written again."""
    def write_batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    with rocksdb_state(spark):
        q = (classify(read_stream(spark, landing).dropDuplicates(["post_id"]), status).writeStream
             .foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
        q.awaitTermination()


def run_counts(spark: SparkSession, landing: str, sink: str, checkpoint: str) -> None:
    """ST4 keyed: running post count per subreddit kept in streaming state;
    every batch rewrites the snapshot of the changed keys."""
    counts = read_stream(spark, landing).groupBy("subreddit").agg(F.count(F.lit(1)).alias("n_posts"))

    def write_batch(df: DataFrame, batch_id: int) -> None:
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            f"{sink}/batch_id={batch_id}")

    q = (counts.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_counts(sink_df: DataFrame) -> DataFrame:
    """Last value per key across the update snapshots."""
    return sink_df.groupBy("subreddit").agg(F.max_by("n_posts", "batch_id").alias("n_posts"))


def running_totals(sink_df: DataFrame) -> DataFrame:
    """ST4: rows per micro-batch and the cumulative counter after it (the
    per-batch table is tiny, one row per batch)."""
    from pyspark.sql import Window
    per = sink_df.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_posts"))
    w = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn("counter", F.sum("n_posts").over(w))
