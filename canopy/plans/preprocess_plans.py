"""Stage 2 queries: text cleaning (F1-F5), filters (P9-P12) and dedupes (A2a-e, A3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from canopy.functions import text as T
from canopy.operators import dedupe as D
from canopy.plans import sql as S
from canopy.plans.registry import register
from canopy.sources.tables import messages
from canopy.operators.util import materialize, ts_string

SRC_ONLY = S.with_(S.SRC)


# ---------------------------------------------------------------- F1-F5
@register("remove_urls", SRC_ONLY + f"SELECT custom_id, {S.url_sql('text')} AS out_text FROM src", "F1")
def q_remove_urls(spark, sf):
    return messages(spark, sf).select("custom_id", T.remove_urls("text").alias("out_text"))


@register("split_hashtags", SRC_ONLY + f"SELECT custom_id, {S.hashtag_sql('text')} AS out_text FROM src",
          "F2 V4")
def q_split_hashtags(spark, sf):
    return messages(spark, sf).select("custom_id", T.split_hashtags("text").alias("out_text"))


@register("remove_mentions", SRC_ONLY + f"SELECT custom_id, {S.mention_sql('text')} AS out_text FROM src", "F3")
def q_remove_mentions(spark, sf):
    return messages(spark, sf).select("custom_id", T.remove_mentions("text").alias("out_text"))


@register("squeeze_spaces",
          SRC_ONLY + "SELECT custom_id, replace(replace(text, '   ', ' '), '  ', ' ') AS out_text FROM src", "F4")
def q_squeeze_spaces(spark, sf):
    return messages(spark, sf).select("custom_id", T.squeeze_spaces("text").alias("out_text"))


@register("clean_text", S.with_(S.SRC, S.CLEAN) +
          "SELECT custom_id, cleaned_text, CAST(length(cleaned_text) AS BIGINT) AS n_chars FROM clean",
          "F5 V1 F12")
def q_clean_text(spark, sf):
    c = D.cleaned_messages(messages(spark, sf))
    return c.select("custom_id", "cleaned_text", T.char_length("cleaned_text").alias("n_chars"))


# ---------------------------------------------------------------- P9-P12
@register("image_messages", S.with_(S.SRC, S.CLEAN, S.IMG) +
          "SELECT custom_id, cleaned_text FROM img WHERE length(cleaned_text) > 0", "P9 P10 P11")
def q_image_messages(spark, sf):
    return D.image_messages(D.cleaned_messages(messages(spark, sf))).select("custom_id", "cleaned_text")


@register("dropna_pairs", S.with_(S.SRC, S.CLEAN) +
          "SELECT custom_id, cleaned_text, dhash FROM clean WHERE cleaned_text IS NOT NULL AND dhash IS NOT NULL",
          "P12")
def q_dropna_pairs(spark, sf):
    c = D.cleaned_messages(messages(spark, sf))
    return c.na.drop(subset=["cleaned_text", "dhash"]).select("custom_id", "cleaned_text", "dhash")


# ---------------------------------------------------------------- A2a-e
def _corpus_cols(df):
    return df.select("custom_id", "cleaned_text", "dhash", ts_string("msg_date_dt").alias("msg_date"))


_OUT = f"SELECT custom_id, cleaned_text, dhash, strftime(msg_date_dt, {S.TS_FMT}) AS msg_date FROM "


@register("dedupe_message", S.with_(*S.STAGE2) + _OUT + "prepared", "A2a W1")
def q_dedupe_message(spark, sf):
    return _corpus_cols(D.prepared(messages(spark, sf)))


@register("dedupe_base", S.with_(*S.STAGE2, S.keep_first_sql("c", "prepared", "cleaned_text, dhash")) + _OUT + "c",
          "A2b")
def q_dedupe_base(spark, sf):
    return _corpus_cols(D.base_corpus(D.prepared(messages(spark, sf))))


@register("dedupe_text", S.with_(*S.STAGE2, S.keep_first_sql("c", "prepared", "cleaned_text")) + _OUT + "c",
          "A2c")
def q_dedupe_text(spark, sf):
    return _corpus_cols(D.text_corpus(D.prepared(messages(spark, sf))))


@register("dedupe_image", S.with_(*S.STAGE2, S.keep_first_sql("c", "prepared", "dhash")) + _OUT + "c", "A2d")
def q_dedupe_image(spark, sf):
    return _corpus_cols(D.image_corpus(D.prepared(messages(spark, sf))))


@register("dedupe_multimodal", S.with_(*S.STAGE2, S.keep_first_sql("c1", "prepared", "dhash"),
                                       S.keep_first_sql("c", "c1", "cleaned_text")) + _OUT + "c", "A2e")
def q_dedupe_multimodal(spark, sf):
    return _corpus_cols(D.multimodal_corpus(D.prepared(messages(spark, sf))))


_SIZES_SQL = S.with_(
    *S.STAGE2,
    S.keep_first_sql("b", "prepared", "cleaned_text, dhash"),
    S.keep_first_sql("t", "prepared", "cleaned_text"),
    S.keep_first_sql("i", "prepared", "dhash"),
    S.keep_first_sql("m", "i", "cleaned_text"),
    S.keep_first_sql("t2", "t", "dhash"),
) + """SELECT corpus, count(*) AS n_rows FROM (
  SELECT 'prepared' AS corpus FROM prepared UNION ALL SELECT 'base' FROM b UNION ALL SELECT 'text' FROM t
  UNION ALL SELECT 'image' FROM i UNION ALL SELECT 'multimodal' FROM m
  UNION ALL SELECT 'multimodal_text_first' FROM t2) GROUP BY corpus"""


@register("corpus_sizes", _SIZES_SQL, "A3")
def q_corpus_sizes(spark, sf):
    base = materialize(D.prepared(messages(spark, sf)).select("custom_id", "cleaned_text", "dhash", "msg_date_dt"))
    return D.corpus_sizes_from(base)
