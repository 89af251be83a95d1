"""Driver tables and the derived views every stage starts from.

All views are plain DataFrame transformations of the given Parquet tables,
so their size grows with the data and Catalyst can prune and push filters
through them.  The derivation rules (which document is re-collected, which
one reposted, media type by id) are the fixture rules of ``FIXTURES.md``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the message view: appended decoration and the epoch of the feed.
TEXT_DECORATION = (" https://ex.org/", " #GutenMorgen #ÄrzteBlatt @", "     ende")
FEED_EPOCH = "2024-10-01 00:00:00"
MEDIA_ID_BASE = 900000
HASH_MOD = 390


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (Parquet; filters and projections push down)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(ts: str) -> Column:
    return F.lit(ts).cast("timestamp_ntz")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SRC``: one row per collected message.

    Copy 0 is every document; copy 1 re-collects the same message in the
    same channel a minute later (doc_id % 7 = 0); copy 2 reposts it into the
    ``repost`` channel (doc_id % 11 = 0).  Copies are produced with an
    ``explode`` (map-side, no join).
    """
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"), "lang", "source")
    cp = F.explode(F.filter(F.array(F.lit(0),
                                    F.when(F.col("doc_id") % 7 == 0, F.lit(1)),
                                    F.when(F.col("doc_id") % 11 == 0, F.lit(2))),
                            lambda x: x.isNotNull())).alias("cp")
    d = d.select("*", cp)
    kind = (F.when(F.col("doc_id") % 10 == 6, "audio").when(F.col("doc_id") % 10 == 7, "video")
            .when(F.col("doc_id") % 10 == 8, "text").when(F.col("doc_id") % 10 == 9, "web_page")
            .otherwise("image"))
    channel = F.when(F.col("cp") == 2, F.lit("repost")).otherwise(F.col("source"))
    d = d.select("doc_id", "body", "lang", "cp", channel.alias("channel_name"), kind.alias("msg_type"))
    doc = F.col("doc_id").cast("string")
    return d.select(
        F.col("doc_id").alias("message_id"),
        "channel_name",
        F.concat(F.col("channel_name"), F.lit("_"), doc).alias("custom_id"),
        F.concat(F.col("body"), F.lit(TEXT_DECORATION[0]), doc, F.lit(TEXT_DECORATION[1]),
                 F.col("channel_name"), F.lit(TEXT_DECORATION[2])).alias("text"),
        "lang",
        "msg_type",
        (_ntz(FEED_EPOCH) + F.make_dt_interval(F.lit(0), F.col("doc_id").cast("int"), F.col("cp")))
        .alias("msg_date_dt"),
        F.when(F.col("msg_type").isin("image", "audio"),
               (F.lit(MEDIA_ID_BASE) + F.col("doc_id")).cast("string")).alias("media_id"),
        F.when((F.col("msg_type") == "image") & (F.col("doc_id") % 50 != 0),
               F.substring(F.md5((F.col("doc_id") % HASH_MOD).cast("string")), 1, 16)).alias("dhash"),
    )


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel dimension: every channel seen in SRC plus one invalid row
    (channel_id -1) and one channel that never posted.

    Channels are few (bounded by the number of sources); the distinct is a
    tiny aggregate, safe to broadcast downstream.
    """
    names = messages(spark, sf_dir).select("channel_name").distinct()
    extra = spark.createDataFrame([("silent_channel",), ("invalid_channel",)], "channel_name string")
    base = names.unionByName(extra)
    num = F.coalesce(F.regexp_extract("channel_name", r"(\d+)$", 1).try_cast("bigint"), F.lit(97))
    cid = (F.when(F.col("channel_name") == "invalid_channel", F.lit(-1).cast("bigint"))
           .otherwise(F.lit(1000000) + num * 13 + F.length("channel_name")))
    return base.select(
        "channel_name",
        cid.alias("channel_id"),
        (num * 7919 % 100003).cast("string").alias("access_hash"),
        F.concat(F.lit("cat"), (num % 4).cast("string")).alias("category"),
        (num * 101 + 5).alias("participant_count"),
        F.concat(F.lit("About "), F.col("channel_name")).alias("channel_description"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reddit-style posts derived from ``pages``.

    The url is decorated so it ends in an image suffix, points at a gallery,
    both, or neither; ``author`` is missing for every 9th page.
    """
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    suffix = (F.when(F.col("page_id") % 4 == 0, "/a.jpg").when(F.col("page_id") % 4 == 1, "/gallery/x")
              .when(F.col("page_id") % 4 == 2, "/gallery.png").otherwise(""))
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    return p.select(
        F.concat(F.lit("s"), (F.col("page_id") % 8).cast("string")).alias("subreddit"),
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("post_id"),
        title.alias("title"),
        F.regexp_extract("html", r"<article>.*?<p>([^<]*)", 1).alias("selftext"),
        (F.lit(1704067200) + F.col("page_id") * 60).alias("created_utc"),
        F.when(F.col("page_id") % 9 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("u"), (F.col("page_id") % 17).cast("string"))).alias("author_name"),
        (F.col("page_id") * 37 % 101).alias("score"),
        (F.col("page_id") % 13).alias("num_comments"),
        F.concat(F.col("url"), suffix).alias("url"),
        F.when(F.col("page_id") % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("flair"), (F.col("page_id") % 3).cast("string"))).alias("flair"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as a collector would land them: a nested ``media`` struct
    (photo / document with mime type / webpage / poll / none), optional
    counters, and some rows with NULL or empty text.
    """
    src = messages(spark, sf_dir)
    r = F.col("message_id")
    kind = (F.when(F.col("msg_type") == "text", F.lit(None).cast("string"))
            .when(r % 13 == 3, "document").when(r % 17 == 5, "poll")
            .when(F.col("msg_type") == "image", "photo")
            .when(F.col("msg_type").isin("audio", "video"), "document")
            .otherwise("webpage"))
    mime = (F.when(r % 13 == 3, "application/pdf").when(F.col("msg_type") == "audio", "audio/ogg")
            .otherwise("video/mp4"))
    media_id = F.lit(MEDIA_ID_BASE) + r
    access = r * 7919 % 1000003
    media = F.when(kind.isNotNull(), F.struct(
        kind.alias("kind"),
        F.when(kind == "photo", F.struct(media_id.alias("id"), access.alias("access_hash"))).alias("photo"),
        F.when(kind == "document", F.struct(media_id.alias("id"), access.alias("access_hash"),
                                            mime.alias("mime_type"))).alias("document"),
    ))
    text = F.when(r % 19 == 4, F.lit(None).cast("string")).when(r % 23 == 6, F.lit("")).otherwise(F.col("text"))
    return src.select(
        "message_id", "channel_name", "custom_id", text.alias("text"), "msg_date_dt", "lang",
        F.when(r % 6 == 0, F.lit(None).cast("bigint")).otherwise(r * 3 % 1000).alias("views"),
        F.when(r % 4 == 1, F.lit(None).cast("bigint")).otherwise(r % 50).alias("forwards"),
        F.when(r % 29 == 0, r % 5).alias("via_bot_id"),
        F.when(r % 10 == 3, F.col("msg_date_dt") + F.make_dt_interval(F.lit(0), F.lit(2))).alias("edit_date"),
        F.when(r % 8 == 5, r % 97).alias("fwd_from"),
        F.when(r % 5 != 2, r % 11).alias("replies"),
        F.when(r % 9 == 7, r - 1).alias("reply_to"),
        media.alias("media"),
    )


def galleries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gallery posts with their item list and media-metadata map.

    Every gallery post has 1-4 items; the metadata map lacks the key of
    the last item when page_id % 7 = 1 (the reference fails that post).
    """
    p = posts(spark, sf_dir).where(F.col("url").contains("gallery"))
    pid = F.regexp_extract("post_id", r"(\d+)$", 1).try_cast("bigint")
    n = (pid % 4 + 1).cast("int")
    idx = F.sequence(F.lit(0), n - 1)
    mid = lambda i: F.concat(F.col("post_id"), F.lit("m"), i.cast("string"))
    items = F.transform(idx, lambda i: F.struct(mid(i).alias("media_id")))
    kept = F.filter(idx, lambda i: ~((pid % 7 == 1) & (i == n - 1)))
    meta = F.map_from_arrays(
        F.transform(kept, mid),
        F.transform(kept, lambda i: F.struct(F.struct(
            F.concat(F.lit("https://i.ex/"), mid(i), F.lit(".jpg")).alias("u")).alias("s"))))
    return p.select("subreddit", "post_id", items.alias("items"), meta.alias("media_metadata"))


def fetch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of each media fetch: one row per image post and per gallery
    item (``idx``; -1 for a single image)."""
    p = posts(spark, sf_dir)
    pid = F.regexp_extract("post_id", r"(\d+)$", 1).try_cast("bigint")
    img = (p.where(F.col("url").endswith("jpg") | F.col("url").endswith("png") | F.col("url").endswith("jpeg"))
           .select("post_id", F.lit(-1).alias("idx"), (pid % 3 != 0).alias("ok")))
    gal = (galleries(spark, sf_dir).select("post_id", F.posexplode("items").alias("idx", "item"))
           .select("post_id", "idx", ((F.regexp_extract("post_id", r"(\d+)$", 1).try_cast("bigint") + F.col("idx"))
                                      % 5 != 0).alias("ok")))
    return img.unionByName(gal)


def failed_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels whose collection broke off (a rule on the channel number)."""
    num = F.regexp_extract("channel_name", r"(\d+)$", 1).try_cast("bigint")
    return channels(spark, sf_dir).where(num % 10 == 7).select("channel_name")


def subreddits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subreddit dimension (category, subreddit, link, subreddit_name) as
    seen in the posts; the category is a rule on the subreddit number."""
    names = posts(spark, sf_dir).select("subreddit").distinct()
    num = F.regexp_extract("subreddit", r"(\d+)$", 1).try_cast("bigint")
    return names.select(
        F.concat(F.lit("c"), (num % 3).cast("string")).alias("category"),
        F.col("subreddit"),
        F.concat(F.lit("/r/"), F.col("subreddit")).alias("link"),
        F.col("subreddit").alias("subreddit_name"),
    )
