"""Stage 1 queries: records, routing, channels, posts, galleries, sinks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from canopy.functions import media as M
from canopy.operators import dedupe as D
from canopy.operators import records as R
from canopy.operators import sinks as K
from canopy.operators.util import ts_string
from canopy.plans import sql as S
from canopy.plans.registry import register
from canopy.sources import tables as TB

# Collection window of the topic-model run and a fixed collection date.
WINDOW = ("2024-11-01 00:00:00", "2024-11-30 00:00:00")
COLLECTED_ON = "2024-12-01"
HOT_LIMIT = 5
FLUSH_EVERY = 100

_RAW = S.with_(S.SRC, S.RAW)
_CH = S.with_(S.SRC, S.CHANNELS)
_POSTS = S.with_(S.POSTS)
_TS = S.TS_FMT


# ---------------------------------------------------------------- messages
@register("message_type", _RAW + "SELECT custom_id, msg_type FROM typed", "P19 F10")
def q_message_type(spark, sf):
    return R.typed_messages(TB.raw_messages(spark, sf)).select("custom_id", "msg_type")


@register("media_keys", _RAW + "SELECT custom_id, access_hash, media_id FROM typed", "P22 N4")
def q_media_keys(spark, sf):
    return R.typed_messages(TB.raw_messages(spark, sf)).select("custom_id", "access_hash", "media_id")


@register("message_record", S.with_(S.SRC, S.RAW, S.CHANNELS) + f"""
SELECT t.channel_name, coalesce(CAST(c.channel_id AS VARCHAR), 'None') AS channel_id,
       CAST(t.message_id AS VARCHAR) AS message_id, t.channel_name || '_' || CAST(t.message_id AS VARCHAR) AS custom_id,
       t.via_bot_id, strftime(t.msg_date_dt, {_TS}) AS msg_date, strftime(t.edit_date, {_TS}) AS edit_date, t.text,
       coalesce(CAST(t.views AS VARCHAR), 'None') AS views, coalesce(CAST(t.forwards AS VARCHAR), 'None') AS forwards,
       coalesce(CAST(t.fwd_from AS VARCHAR), 'None') AS fwd_from,
       coalesce(CAST(t.replies AS VARCHAR), 'None') AS replies,
       coalesce(CAST(t.reply_to AS VARCHAR), 'None') AS reply_to,
       CASE WHEN kind = 'photo' THEN '{{"kind":"photo","photo":{{"id":' || CAST(900000 + t.message_id AS VARCHAR)
              || ',"access_hash":' || CAST(t.message_id * 7919 % 1000003 AS VARCHAR) || '}}}}'
            WHEN kind = 'document' THEN '{{"kind":"document","document":{{"id":' || CAST(900000 + t.message_id AS VARCHAR)
              || ',"access_hash":' || CAST(t.message_id * 7919 % 1000003 AS VARCHAR) || ',"mime_type":"' || mime || '"}}}}'
            WHEN kind IS NOT NULL THEN '{{"kind":"' || kind || '"}}' END AS media,
       t.media_id, t.access_hash,
       '{COLLECTED_ON}' AS collected_on
FROM typed t LEFT JOIN channels c ON t.channel_name = c.channel_name""", "P3 F6 F7 D4")
def q_message_record(spark, sf):
    r = R.message_record(TB.raw_messages(spark, sf), TB.channels(spark, sf), COLLECTED_ON)
    return r.select(*[c for c in r.columns if c not in ("msg_date_dt", "edit_date", "collected_on")],
                    ts_string("msg_date_dt").alias("msg_date"), ts_string("edit_date").alias("edit_date"),
                    F.col("collected_on").cast("string").alias("collected_on"))


@register("media_path", S.with_(S.SRC) + f"""
SELECT custom_id, CASE WHEN msg_type = 'image' THEN '{M.DATA_DIR}/' || channel_name || '/images/' || media_id || '.jpg'
                       WHEN msg_type = 'audio' THEN '{M.DATA_DIR}/' || channel_name || '/audio/' || media_id || '.png'
                  END AS file_path FROM src""", "F8 V2")
def q_media_path(spark, sf):
    return TB.messages(spark, sf).select("custom_id", M.media_path().alias("file_path"))


@register("media_messages", S.with_(S.SRC) + "SELECT custom_id, msg_type FROM src WHERE msg_type IN ('audio', 'image')",
          "P15")
def q_media_messages(spark, sf):
    return TB.messages(spark, sf).where(F.col("msg_type").isin("audio", "image")).select("custom_id", "msg_type")


@register("date_window", S.with_(S.SRC) + f"""
SELECT custom_id, strftime(msg_date_dt, {_TS}) AS msg_date FROM src
WHERE msg_date_dt BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'""", "P13 P14 D2")
def q_date_window(spark, sf):
    w = R.in_window(TB.messages(spark, sf), *WINDOW)
    return w.select("custom_id", ts_string("msg_date_dt").alias("msg_date"))


@register("latest_messages", S.with_(S.SRC) + f"""
SELECT channel_name, custom_id, strftime(msg_date_dt, {_TS}) AS msg_date, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_name ORDER BY msg_date_dt DESC, custom_id) AS rank FROM src)""", "T2")
def q_latest_messages(spark, sf):
    top = R.top_per_group(TB.messages(spark, sf), "channel_name",
                          [F.col("msg_date_dt").desc(), F.col("custom_id")], None)
    return top.select("channel_name", "custom_id", ts_string("msg_date_dt").alias("msg_date"),
                      F.col("rank").cast("bigint").alias("rank"))


# ---------------------------------------------------------------- channels
@register("filter_valid_channels", _CH + "SELECT channel_name, channel_id FROM channels WHERE channel_id IS DISTINCT FROM -1",
          "P7")
def q_filter_valid_channels(spark, sf):
    return R.valid_channels(TB.channels(spark, sf)).select("channel_name", "channel_id")


@register("distinct_channels", _CH + """
SELECT c.category, count(DISTINCT s.channel_name) AS n_channels, count(*) AS n_messages
FROM src s JOIN channels c ON s.channel_name = c.channel_name WHERE c.channel_id IS DISTINCT FROM -1
GROUP BY c.category""", "A1 P8")
def q_distinct_channels(spark, sf):
    j = R.enrich(TB.messages(spark, sf), R.valid_channels(TB.channels(spark, sf))).where(F.col("category").isNotNull())
    return j.groupBy("category").agg(F.count_distinct("channel_name").alias("n_channels"),
                                     F.count(F.lit(1)).alias("n_messages"))


@register("enrich_channel", _CH + """
SELECT s.custom_id, c.category, c.participant_count, c.channel_description
FROM src s LEFT JOIN channels c ON s.channel_name = c.channel_name""", "J3")
def q_enrich_channel(spark, sf):
    return R.enrich(TB.messages(spark, sf), TB.channels(spark, sf)).select(
        "custom_id", "category", "participant_count", "channel_description")


@register("channel_coverage", _CH + """
SELECT c.channel_name, c.category, coalesce(n.n, 0) AS n_messages,
       CASE WHEN TRY_CAST(regexp_extract(c.channel_name, '(\\d+)$', 1) AS BIGINT) % 10 = 7 THEN 'failed'
            WHEN n.n > 0 THEN 'success' ELSE 'no data' END AS status
FROM channels c LEFT JOIN (SELECT channel_name, count(*) AS n FROM src GROUP BY channel_name) n
  ON c.channel_name = n.channel_name
WHERE c.channel_id IS DISTINCT FROM -1""", "J9")
def q_channel_coverage(spark, sf):
    return R.channel_coverage(TB.channels(spark, sf), TB.messages(spark, sf), TB.failed_channels(spark, sf))


@register("attach_window_cols", _CH + f"""
SELECT s.custom_id, c.category, strftime(TIMESTAMP '{WINDOW[0]}', '%Y_%m_%d') AS start_date,
       strftime(TIMESTAMP '{WINDOW[1]}', '%Y_%m_%d') AS end_date
FROM src s LEFT JOIN channels c ON s.channel_name = c.channel_name
WHERE s.msg_date_dt BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'""", "P5 D3")
def q_attach_window_cols(spark, sf):
    m = R.in_window(TB.messages(spark, sf), *WINDOW)
    e = R.enrich(m, TB.channels(spark, sf))
    return R.attach_window_cols(e, *WINDOW).select("custom_id", "category", "start_date", "end_date")


# ---------------------------------------------------------------- corpora routing
@register("corpus_span", S.with_(*S.STAGE2, S.keep_first_sql("c", "prepared", "cleaned_text")) + f"""
SELECT count(*) AS n_rows, strftime(min(msg_date_dt), {_TS}) AS min_date, strftime(max(msg_date_dt), {_TS}) AS max_date
FROM c WHERE msg_date_dt BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'""", "A4")
def q_corpus_span(spark, sf):
    c = R.in_window(D.corpus(TB.messages(spark, sf), "text"), *WINDOW)
    return c.agg(F.count(F.lit(1)).alias("n_rows"), ts_string(F.min("msg_date_dt")).alias("min_date"),
                 ts_string(F.max("msg_date_dt")).alias("max_date"))


@register("corpus_route", S.with_(*S.STAGE2, S.keep_first_sql("c", "prepared", "cleaned_text, dhash")) + f"""
SELECT custom_id, cleaned_text, '{M.DATA_DIR}/' || channel_name || '/images/' || media_id || '.jpg' AS file_path,
       'base_mm_20_nov' AS model_version
FROM c WHERE msg_date_dt BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'""", "P18 P2 F11")
def q_corpus_route(spark, sf):
    c = R.in_window(D.route(TB.messages(spark, sf), "base", "mm"), *WINDOW)
    version = F.concat_ws("_", F.lit("base"), F.lit("mm"), F.lit(20).cast("string"), F.lit("nov"))
    return c.select("custom_id", "cleaned_text", M.media_path().alias("file_path"), version.alias("model_version"))


@register("scan_table", "SELECT * FROM documents", "S1 P1")
def q_scan_table(spark, sf):
    return TB.table(spark, sf, "documents")


# ---------------------------------------------------------------- posts
@register("post_record", S.with_(S.POSTS, S.GALLERY_ITEMS, S.STATUS) + f"""
SELECT p.subreddit, p.post_id, p.title, p.selftext,
       strftime(make_timestamp(CAST(p.created_utc AS BIGINT) * 1000000), {_TS}) AS created,
       coalesce(p.author_name, 'Deleted') AS author, p.score, p.num_comments, p.url, p.flair, s.download_status
FROM posts p JOIN status s USING (post_id)""", "P4 D1 P20")
def q_post_record(spark, sf):
    p = TB.posts(spark, sf)
    status = R.download_status(p, TB.galleries(spark, sf), TB.fetch_results(spark, sf))
    return R.post_record(p, status).withColumn("created", ts_string("created"))


@register("url_media_kind", _POSTS + f"SELECT post_id, url, {S.IS_IMAGE} AS is_image, {S.IS_GALLERY} AS is_gallery FROM posts",
          "P16 P17 F10")
def q_url_media_kind(spark, sf):
    return TB.posts(spark, sf).select("post_id", "url", M.is_image_url().alias("is_image"),
                                      M.is_gallery_url().alias("is_gallery"))


@register("gallery_items", S.with_(S.POSTS, S.GALLERY_ITEMS) +
          "SELECT subreddit, post_id, idx, media_id, url, file_name FROM gitems", "J4 N3 N4 F9")
def q_gallery_items(spark, sf):
    return R.gallery_items(TB.galleries(spark, sf)).withColumn("idx", F.col("idx").cast("bigint"))


@register("download_status", S.with_(S.POSTS, S.GALLERY_ITEMS, S.STATUS) + "SELECT post_id, download_status FROM status",
          "P20")
def q_download_status(spark, sf):
    return R.download_status(TB.posts(spark, sf), TB.galleries(spark, sf), TB.fetch_results(spark, sf))


@register("hot_per_subreddit", _POSTS + f"""
SELECT subreddit, post_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY score DESC, post_id) AS rank FROM posts)
WHERE rank <= {HOT_LIMIT}""", "T1 W2 S14")
def q_hot_per_subreddit(spark, sf):
    top = R.top_per_group(TB.posts(spark, sf), "subreddit", [F.col("score").desc(), F.col("post_id")], HOT_LIMIT)
    return top.select("subreddit", "post_id", "score", F.col("rank").cast("bigint").alias("rank"))


@register("posts_per_subreddit", _POSTS + "SELECT subreddit, count(*) AS n_posts FROM posts GROUP BY subreddit", "A5")
def q_posts_per_subreddit(spark, sf):
    return TB.posts(spark, sf).groupBy("subreddit").agg(F.count(F.lit(1)).alias("n_posts"))


@register("batch_of_100", _POSTS + f"""
SELECT batch_no, count(*) AS n_posts, min(counter) AS first_counter, max(counter) AS last_counter,
       arg_min(post_id, counter) AS first_post, arg_max(post_id, counter) AS last_post FROM (
  SELECT post_id, row_number() OVER (ORDER BY created_utc, post_id) AS counter,
         (row_number() OVER (ORDER BY created_utc, post_id) - 1) // {FLUSH_EVERY} AS batch_no FROM posts)
GROUP BY batch_no""", "W6 M6 ST2")
def q_batch_of_100(spark, sf):
    b = R.batches_of(TB.posts(spark, sf), ["created_utc", "post_id"], FLUSH_EVERY)
    return b.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_posts"), F.min("counter").alias("first_counter"),
        F.max("counter").alias("last_counter"), F.min_by("post_id", "counter").alias("first_post"),
        F.max_by("post_id", "counter").alias("last_post"))


_SUBS = """subs AS (SELECT DISTINCT 'c' || CAST(page_id % 8 % 3 AS VARCHAR) AS category, subreddit AS subreddit_name
                    FROM posts)"""


@register("subreddit_selector", S.with_(S.POSTS, _SUBS) + """
SELECT category, array_to_string(list_sort(list(subreddit_name)), '+') AS selector, count(*) AS n_subreddits
FROM subs GROUP BY category""", "F16 S2")
def q_subreddit_selector(spark, sf):
    subs = TB.subreddits(spark, sf)
    sel = R.subreddit_selector(subs)
    back = sel.select("category", F.explode(F.split("selector", r"\+")).alias("s")).groupBy("category").agg(
        F.count(F.lit(1)).alias("n_subreddits"))
    return sel.join(back, "category")


# ---------------------------------------------------------------- sinks (write, read back)
@register("sink_by_channel", _CH + """
SELECT c.category, s.channel_name, count(*) AS n_rows FROM src s JOIN channels c ON s.channel_name = c.channel_name
GROUP BY c.category, s.channel_name""", "S3 P8")
def q_sink_by_channel(spark, sf):
    e = R.enrich(TB.messages(spark, sf), TB.channels(spark, sf))
    back = K.write_by_channel(e.select("custom_id", "text", "msg_date_dt", "category", "channel_name"))
    return back.groupBy("category", "channel_name").agg(F.count(F.lit(1)).alias("n_rows"))


@register("load_raw", S.with_(S.SRC) + f"""
SELECT channel_name, count(*) AS n_rows, strftime(min(msg_date_dt), {_TS}) AS first_date,
       strftime(max(msg_date_dt), {_TS}) AS last_date, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM src GROUP BY channel_name""", "S5 S2 U2")
def q_load_raw(spark, sf):
    raw = K.land_csv_and_reload(TB.messages(spark, sf).select(
        "channel_name", "custom_id", "text", "msg_type", ts_string("msg_date_dt").alias("msg_date")))
    return raw.groupBy("channel_name").agg(
        F.count(F.lit(1)).alias("n_rows"), ts_string(F.min("msg_date_dt")).alias("first_date"),
        ts_string(F.max("msg_date_dt")).alias("last_date"), F.sum(F.length("text")).cast("bigint").alias("n_chars"))


@register("csv_roundtrip", """
SELECT doc_id, text, lang, source, CASE WHEN lang = 'en' THEN n_chars END AS n_chars,
       lang IS DISTINCT FROM 'en' AS quarantined
FROM documents""", "S2 S5 U2")
def q_csv_roundtrip(spark, sf):
    """All documents through CSV files; those not in English land with a unit behind
    their length, so the declared type breaks and they go to quarantine."""
    docs = TB.table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    length = F.when(F.col("lang") == "en", F.col("n_chars").cast("string")) \
        .otherwise(F.concat(F.coalesce(F.col("n_chars").cast("string"), F.lit("")), F.lit(" chars")))
    path = K.write_exact_csv(docs.withColumn("n_chars", length))
    good, broken = K.read_quarantined(spark, path, "doc_id long, text string, lang string, source string, n_chars long")
    return good.withColumn("quarantined", F.lit(False)).unionByName(
        broken.drop("raw", "file").withColumn("quarantined", F.lit(True)))


@register("typed_sink", S.with_(*S.STAGE2, S.keep_first_sql("c", "prepared", "cleaned_text")) + f"""
SELECT CAST(message_id AS VARCHAR) AS message_id, custom_id, cleaned_text, dhash,
       strftime(msg_date_dt, {_TS}) AS msg_date FROM c""", "S6")
def q_typed_sink(spark, sf):
    c = D.corpus(TB.messages(spark, sf), "text")
    back = K.write_typed(c)
    return back.select("message_id", "custom_id", "cleaned_text", "dhash", ts_string("msg_date_dt").alias("msg_date"))


__all__ = ["Window"]


FEED_WINDOW = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")


@register("feed_window", f"""
SELECT event_type, count(*) AS n_events, strftime(min(ts), {_TS}) AS first_ts, strftime(max(ts), {_TS}) AS last_ts
FROM events WHERE ts BETWEEN TIMESTAMP '{FEED_WINDOW[0]}' AND TIMESTAMP '{FEED_WINDOW[1]}'
GROUP BY event_type""", "P13 P14 D2")
def q_feed_window(spark, sf):
    """Closed window on a stored timestamp: the bounds reach the Parquet scan
    (PushedFilters) and row groups outside it are skipped."""
    ev = R.in_window(TB.table(spark, sf, "events"), *FEED_WINDOW, col="ts")
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"),
                                        ts_string(F.min("ts")).alias("first_ts"), ts_string(F.max("ts")).alias("last_ts"))
