"""Streaming queries: run the stream to completion over landed posts and
return what the sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from canopy.operators import records as R
from canopy.operators.util import materialize
from canopy.plans import sql as S
from canopy.plans.registry import register
from canopy.session import scratch_path
from canopy.sources import tables as TB
from canopy.streaming import flushes as FL
from canopy.streaming import posts as ST


def _landed(spark, sf):
    p = TB.posts(spark, sf)
    landing = ST.land(p, scratch_path(spark, "landing"))
    status = materialize(R.download_status(p, TB.galleries(spark, sf), TB.fetch_results(spark, sf)), "status")
    return landing, status


@register("stream_posts", S.with_(S.POSTS, S.GALLERY_ITEMS, S.STATUS) + f"""
SELECT p.subreddit, p.post_id, p.created_utc, coalesce(p.author_name, 'Deleted') AS author, p.url,
       {S.IS_IMAGE.replace('url', 'p.url')} AS is_image, {S.IS_GALLERY.replace('url', 'p.url')} AS is_gallery,
       s.download_status
FROM posts p JOIN status s USING (post_id)""", "ST1 ST3 S13 S4")
def q_stream_posts(spark, sf):
    landing, status = _landed(spark, sf)
    sink = scratch_path(spark, "stream_sink")
    ST.run_ingest(spark, landing, sink, scratch_path(spark, "stream_ckpt"), status)
    out = spark.read.parquet(sink)
    return out.select("subreddit", "post_id", "created_utc", "author", "url", "is_image", "is_gallery",
                      "download_status")


@register("stream_batches", S.with_(S.POSTS) + """
SELECT count(*) AS n_posts, count(DISTINCT post_id) AS n_distinct, true AS counter_adds_up FROM posts""", "ST2 ST4")
def q_stream_batches(spark, sf):
    landing, status = _landed(spark, sf)
    sink = scratch_path(spark, "stream_sink")
    ST.run_ingest(spark, landing, sink, scratch_path(spark, "stream_ckpt"), status)
    landed = spark.read.parquet(sink)
    totals = ST.running_totals(landed)
    last = totals.agg(F.max("counter").alias("last"), F.sum("n_posts").alias("sum"))
    rows = landed.agg(F.count("*").alias("n_posts"), F.count_distinct("post_id").alias("n_distinct"))
    return rows.select("n_posts", "n_distinct", (F.col("n_posts") == last.select("last").scalar()).alias("counter_adds_up"))


@register("stream_subreddit_counts", S.with_(S.POSTS) +
          "SELECT subreddit, count(*) AS n_posts FROM posts GROUP BY subreddit", "ST4 A5")
def q_stream_subreddit_counts(spark, sf):
    landing, _ = _landed(spark, sf)
    sink = scratch_path(spark, "count_sink")
    ST.run_counts(spark, landing, sink, scratch_path(spark, "count_ckpt"))
    return ST.latest_counts(spark.read.parquet(sink))


#: Small enough that every subreddit fills flushes in the smaller tables too.
PER_FLUSH = 12


@register("stream_flushes", S.with_(S.POSTS) + f"""
SELECT subreddit, CAST((place - 1) // {PER_FLUSH} AS BIGINT) AS flush_no, count(*) AS n_posts,
       count(DISTINCT post_id) AS n_distinct
FROM (SELECT subreddit, post_id, row_number() OVER (PARTITION BY subreddit ORDER BY post_id) AS place FROM posts)
GROUP BY ALL""", "ST2 ST4 S13")
def q_stream_flushes(spark, sf):
    """Which posts share a flush depends on their arrival, how many there are does not."""
    landing = ST.land(TB.posts(spark, sf), scratch_path(spark, "landing"))
    sink, ckpt = scratch_path(spark, "flush_sink"), scratch_path(spark, "flush_ckpt")
    FL.run_flushes(spark, landing, sink, ckpt, every=PER_FLUSH)
    FL.close(spark, sink, ckpt)
    return FL.flushes(spark, sink).groupBy(F.col("lane").alias("subreddit"), "flush_no").agg(
        F.count(F.lit(1)).alias("n_posts"), F.count_distinct("post_id").alias("n_distinct"))
