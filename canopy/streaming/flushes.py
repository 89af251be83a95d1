"""ST2: flushes of exactly N posts across micro-batches.

The posts of a lane (a subreddit, or whatever column the collector runs by)
wait in streaming state until N are there; then they leave as one numbered
flush.  Replayed posts are recognised by a state of post ids first.  What
still waits when the stream stops is read from the state and written as the
open flush of its lane; a later run goes on from the state, and its own
``close`` replaces that table.

A lane is one state row: its posts are counted one after the other, which is
what a flush by count means, so a single lane over all posts is one task.
Frames of a lane arrive in Arrow batches, so a task holds one batch and less
than N waiting posts, however many posts the lane has.

Defined results: a post without an id counts as one post with a null id; a
null lane is a lane; columns may be null; an empty landing folder gives no
flush at all.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from canopy.streaming import posts as ST

#: Fixed value: posts per flush.
FLUSH_EVERY = 100
_OUT = "lane string, flush_no long, place int, post string"
_STATE = "n_flushes long, waiting string"


def _cutter(every: int):
    def cut(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n_flushes, waiting = state.get if state.exists else (0, "[]")
        waiting = json.loads(waiting)
        for frame in frames:
            waiting += frame["post"].tolist()
            full = len(waiting) - len(waiting) % every
            if full:
                place = pd.RangeIndex(full).to_series()
                yield pd.DataFrame({"lane": key[0], "flush_no": n_flushes + place // every,
                                    "place": (place % every + 1).astype("int32"), "post": waiting[:full]})
                n_flushes += full // every
                waiting = waiting[full:]
        state.update((n_flushes, json.dumps(waiting)))
    return cut


def _posts(df: DataFrame) -> DataFrame:
    return df.select("lane", "flush_no", "place", F.from_json("post", ST.POST_SCHEMA).alias("_p")).select(
        "lane", "flush_no", "place", "_p.*")


def run_flushes(spark: SparkSession, landing: str, sink: str, checkpoint: str, lane: str = "subreddit",
                every: int = FLUSH_EVERY, files_per_trigger: int = 1) -> None:
    """Run to completion; full flushes land in ``sink/flushes/batch_id=N``."""
    stream = ST.read_stream(spark, landing, files_per_trigger).dropDuplicates(["post_id"])
    packed = stream.select(F.col(lane).cast("string").alias("lane"), F.to_json(F.struct(*ST.POST_SCHEMA.names)).alias("post"))
    cut = packed.groupBy("lane").applyInPandasWithState(_cutter(every), _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)

    def write_batch(df: DataFrame, batch_id: int) -> None:
        _posts(df).write.mode("overwrite").parquet(f"{sink}/flushes/batch_id={batch_id}")

    with ST.rocksdb_state(spark):
        q = (cut.writeStream.outputMode("append").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()


def close(spark: SparkSession, sink: str, checkpoint: str) -> None:
    """Write the posts that still wait, per lane, as ``sink/open``."""
    names = spark.read.format("state-metadata").load(checkpoint)
    cutter = names.where(F.lower("operatorName").contains("withstate")).select("operatorId").first()
    state = spark.read.format("statestore").option("operatorId", cutter["operatorId"]).load(checkpoint)
    left = state.select(F.col("key.lane").alias("lane"), F.col("value.groupState.n_flushes").alias("flush_no"),
                        F.posexplode(F.from_json("value.groupState.waiting", T.ArrayType(T.StringType()))).alias("_i", "post"))
    _posts(left.withColumn("place", F.col("_i") + 1)).write.mode("overwrite").parquet(f"{sink}/open")


def flushes(spark: SparkSession, sink: str) -> DataFrame:
    """All posts with their lane, flush and place: full flushes and the open one of each lane."""
    full = spark.read.parquet(f"{sink}/flushes").drop("batch_id")
    return full.unionByName(spark.read.parquet(f"{sink}/open"))
