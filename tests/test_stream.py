"""Streaming ingest: replays dedupe within the watermark, every post lands
once, restart from checkpoint adds nothing."""

import tempfile

from pyspark.sql import functions as F

from canopy.operators import records as R
from canopy.sources import tables as TB
from canopy.streaming import posts as ST
from tests.conftest import SF_SMALL


def test_stream_dedupes_replays_and_restarts(spark):
    root = tempfile.mkdtemp(prefix="canopy-stream-", dir="/tmp")
    p = TB.posts(spark, SF_SMALL)
    landing = ST.land(p, f"{root}/landing")
    # a replay of the last flush (same posts collected again)
    ST.land(p.orderBy(F.col("created_utc").desc()).limit(5), f"{root}/landing", n_flushes=1)
    status = R.download_status(p, TB.galleries(spark, SF_SMALL), TB.fetch_results(spark, SF_SMALL))
    ST.run_ingest(spark, landing, f"{root}/sink", f"{root}/ckpt", status)
    out = spark.read.parquet(f"{root}/sink")
    assert out.count() == p.count()
    assert out.select("post_id").distinct().count() == p.count()
    ST.run_ingest(spark, landing, f"{root}/sink", f"{root}/ckpt", status)
    assert spark.read.parquet(f"{root}/sink").count() == p.count()
