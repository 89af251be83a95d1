"""Record building, routing and collection-side operators.

Everything here is a projection, filter, small-dimension join or a
per-key window; none of it needs Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopy.functions import media as M
from canopy.operators.util import materialize


def typed_messages(raw: DataFrame) -> DataFrame:
    """P19 + P22 over landed raw messages."""
    t = raw.withColumn("msg_type", M.message_type("text", "media"))
    return t.withColumn("_k", M.media_keys("msg_type", "media")).select(
        "*", F.col("_k.access_hash").alias("access_hash"), F.col("_k.media_id").alias("media_id")).drop("_k")


def message_record(raw: DataFrame, channels: DataFrame, collected_on=None) -> DataFrame:
    """The 17-field message record with string-typed ids/counters (F6/F7); the
    media struct is kept as JSON."""
    t = typed_messages(raw)
    ch = channels.select("channel_name", "channel_id")
    return t.join(ch, "channel_name", "left").select(
        "channel_name",
        M.py_str("channel_id").alias("channel_id"),
        F.col("message_id").cast("string").alias("message_id"),
        M.custom_id("channel_name", "message_id").alias("custom_id"),
        "via_bot_id",
        "msg_date_dt",
        "edit_date",
        "text",
        M.py_str("views").alias("views"),
        M.py_str("forwards").alias("forwards"),
        M.py_str("fwd_from").alias("fwd_from"),
        M.py_str("replies").alias("replies"),
        M.py_str("reply_to").alias("reply_to"),
        F.to_json("media").alias("media"),
        "media_id",
        "access_hash",
        (F.lit(collected_on).cast("date") if collected_on else F.current_date()).alias("collected_on"),
    )


def valid_channels(channels: DataFrame) -> DataFrame:
    """``channel_id != -1``; a NULL id is kept, as pandas does."""
    return channels.where(~F.col("channel_id").eqNullSafe(-1))


def in_window(df: DataFrame, start: str, end: str, col: str = "msg_date_dt",
              closed: str = "both") -> DataFrame:
    """Timestamp range on an NTZ column; pushed to the scan."""
    c = F.col(col)
    lo = F.lit(start).cast("timestamp_ntz")
    hi = F.lit(end).cast("timestamp_ntz")
    if closed == "both":
        return df.where(c.between(lo, hi))
    if closed == "left":
        return df.where((c >= lo) & (c < hi))
    raise ValueError("closed must be 'both' or 'left'")


def enrich(messages: DataFrame, channels: DataFrame) -> DataFrame:
    """Channel attributes onto every message (left join on name).

    The channel side is a dimension; AQE turns this into a broadcast hash
    join once the runtime size of that side is known to be small.
    """
    ch = channels.select("channel_name", "category", "participant_count", "channel_description")
    return messages.join(ch, "channel_name", "left")


def attach_window_cols(df: DataFrame, start: str, end: str) -> DataFrame:
    """P5/D3: constant start/end columns formatted ``yyyy_MM_dd``."""
    return df.withColumns({
        "start_date": F.date_format(F.lit(start).cast("timestamp_ntz"), "yyyy_MM_dd"),
        "end_date": F.date_format(F.lit(end).cast("timestamp_ntz"), "yyyy_MM_dd"),
    })


def channel_coverage(channels: DataFrame, messages: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Every requested (valid) channel with its message count and status;
    ``failed`` names the channels whose collection broke off.

    Counts are aggregated per channel before the join (map-side partial
    aggregation), so the join input is one row per channel.
    """
    counts = messages.groupBy("channel_name").agg(F.count(F.lit(1)).alias("n_messages"))
    j = valid_channels(channels).join(counts, "channel_name", "left")
    broke = F.lit(False)
    if failed is not None:
        j = j.join(failed.select("channel_name").distinct().withColumn("_broke", F.lit(True)), "channel_name", "left")
        broke = F.coalesce("_broke", F.lit(False))
    return j.select(
        "channel_name", "category",
        F.coalesce("n_messages", F.lit(0)).alias("n_messages"),
        F.when(broke, F.lit("failed")).when(F.col("n_messages") > 0, F.lit("success"))
        .otherwise(F.lit("no data")).alias("status"),
    )


def post_record(posts: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """The 11-field post record; missing author -> 'Deleted'; epoch ->
    timestamp; a post without a download has the status 'no image'."""
    out = posts.select(
        "subreddit", "post_id", "title", "selftext",
        M.epoch_to_ntz("created_utc").alias("created"),
        F.coalesce("author_name", F.lit(M.DELETED_AUTHOR)).alias("author"),
        "score", "num_comments", "url", "flair",
    )
    if status is not None:
        out = out.join(status, "post_id", "left").withColumn(
            "download_status", F.coalesce("download_status", F.lit("no image")))
    return out


def download_status(posts: DataFrame, galleries: DataFrame, fetches: DataFrame) -> DataFrame:
    """P20: ``no image`` / ``success`` / ``failed`` per post.

    An image URL takes the image fetch result; a gallery URL then
    *overwrites* it with the gallery result, which fails when any item
    fails or its metadata key is missing (J4).
    """
    img = (fetches.where(F.col("idx") == -1)
           .select("post_id", F.col("ok").alias("img_ok")))
    items = gallery_items(galleries).select("post_id", "idx", "url")
    gal = (items.join(fetches.where(F.col("idx") >= 0), ["post_id", "idx"], "left")
           .groupBy("post_id")
           .agg(F.bool_and(F.col("url").isNotNull() & F.coalesce("ok", F.lit(False))).alias("gal_ok")))
    j = posts.select("post_id", "url").join(img, "post_id", "left").join(gal, "post_id", "left")
    st = F.lit("no image")
    st = F.when(M.is_image_url("url"), F.when(F.col("img_ok"), "success").otherwise("failed")).otherwise(st)
    st = F.when(M.is_gallery_url("url"), F.when(F.col("gal_ok"), "success").otherwise("failed")).otherwise(st)
    return j.select("post_id", st.alias("download_status"))


def gallery_items(galleries: DataFrame) -> DataFrame:
    """One row per gallery item with its URL (metadata map
    lookup, no shuffle) and target file name; a missing key gives NULL."""
    ex = galleries.select("subreddit", "post_id", "media_metadata",
                          F.posexplode("items").alias("idx", "item"))
    return ex.select(
        "subreddit", "post_id", "idx",
        F.col("item.media_id").alias("media_id"),
        F.element_at("media_metadata", F.col("item.media_id")).getField("s").getField("u").alias("url"),
        M.gallery_file("subreddit", "post_id", "idx").alias("file_name"),
    )


def top_per_group(df: DataFrame, group: str, order: list, limit: int | None) -> DataFrame:
    """First ``limit`` rows per group (all rows when ``limit`` is None).

    The rank filter becomes a ``WindowGroupLimit`` below the exchange, so
    each map task forwards at most ``limit`` rows per group.
    """
    w = Window.partitionBy(group).orderBy(*order)
    ranked = df.withColumn("rank", F.row_number().over(w))
    return ranked if limit is None else ranked.where(F.col("rank") <= limit)


def global_index(df: DataFrame, order: list, name: str = "idx", parts: int | None = None) -> DataFrame:
    """Dense 0-based position in a total order, without a single-partition
    window.

    Rows are range-partitioned on the (unique) order key, sorted inside each
    range and written once; partition number and position come from that
    table, and so do the sizes whose running total shifts every range.  The
    offset table has one row per range, so it is broadcast.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("_at", F.monotonically_increasing_id()), "index")
    # the id holds the partition above 33 bits of the position in it
    local = placed.withColumn("_pid", F.shiftright("_at", 33))
    sizes = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1))).alias("_off"))
    position = F.col("_at").bitwiseAND((1 << 33) - 1)
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.coalesce("_off", F.lit(0)) + position).cast("bigint"))
            .drop("_pid", "_at", "_off"))


def batches_of(df: DataFrame, order: list, size: int = 100) -> DataFrame:
    """Batch number of each record in arrival order (flush every ``size``)."""
    ix = global_index(df, order, "_i")
    return ix.withColumn("batch_no", F.floor(F.col("_i") / size).cast("bigint")).withColumn(
        "counter", F.col("_i") + 1).drop("_i")


def subreddit_selector(subreddits: DataFrame) -> DataFrame:
    """F16: ``a+b+c`` selector per category (sorted, so deterministic)."""
    return subreddits.groupBy("category").agg(
        F.array_join(F.sort_array(F.collect_set("subreddit_name")), "+").alias("selector"))
