"""Stage 3 queries on given labels: topic sizes, c-TF-IDF, terms,
representative documents, topic and document info, model round trip."""

from __future__ import annotations

from pyspark.sql import functions as F

from canopy.functions.text import tokens
from canopy.operators import dedupe as D
from canopy.operators import topics as TP
from canopy.operators.model_store import DensityTopicsModel, version_path
from canopy.operators.sinks import roundtrip_model
from canopy.operators.util import materialize
from canopy.plans import sql as S
from canopy.plans.registry import register
from canopy.session import scratch_path
from canopy.sources import tables as TB

# Outlier rule of the label-based assignment and the minimum topic size.
OUTLIER_MOD = 13
MIN_SIZE = 25


def text_docs(spark, sf):
    """Documents of the text corpus keyed by ``doc_key``."""
    c = D.corpus(TB.messages(spark, sf), "text")
    return c.select(F.col("custom_id").alias("doc_key"), F.col("cleaned_text").alias("text"),
                    "message_id", "lang", "channel_name")


def label_assign(docs):
    """``assign_text``: topic = dense id of ``lang``; every 13th message is an outlier."""
    d = TP.dense_ids(docs, "lang", "_lid")
    return d.select("doc_key", F.when(F.col("message_id") % OUTLIER_MOD == 0, F.lit(TP.OUTLIER))
                    .otherwise(F.col("_lid")).cast("int").alias("topic"))


def model_tables(spark, sf):
    """Fit once: the corpus, the assignment and the c-TF-IDF weights are
    written to the shared folder and every downstream table reads them."""
    docs = materialize(text_docs(spark, sf))
    assign = materialize(label_assign(docs))
    dt = materialize(TP.doc_terms(docs))
    weights = materialize(TP.ctfidf(TP.topic_term_counts(docs, assign, dt=dt)))
    return docs, assign, weights, dt


_DOCS_SQL = "SELECT custom_id AS doc_key, cleaned_text AS text, message_id, lang, channel_name FROM tc"
_ASSIGN_SQL = f"""SELECT d.doc_key, CAST(CASE WHEN d.message_id % {OUTLIER_MOD} = 0 THEN -1 ELSE l.lid END AS INTEGER) AS topic
FROM docs d JOIN (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS lid FROM (SELECT DISTINCT lang FROM docs)) l
USING (lang)"""
TOPIC_WITH = S.with_(*S.STAGE2, S.keep_first_sql("tc", "prepared", "cleaned_text"),
                     *S.topic_ctes(_DOCS_SQL, _ASSIGN_SQL))


@register("tokens", TOPIC_WITH + f"""
SELECT doc_key, CAST(len({S.tokens_sql('text')}) AS BIGINT) AS n_tokens,
       array_to_string({S.tokens_sql('text')}, ' ') AS token_text FROM docs""", "F18")
def q_tokens(spark, sf):
    d = text_docs(spark, sf)
    t = tokens("text")
    return d.select("doc_key", F.size(t).cast("bigint").alias("n_tokens"), F.array_join(t, " ").alias("token_text"))


@register("topic_sizes", TOPIC_WITH + "SELECT topic, count(*) AS count FROM assign GROUP BY topic", "A6")
def q_topic_sizes(spark, sf):
    return TP.topic_sizes(label_assign(text_docs(spark, sf)))


@register("topic_count", TOPIC_WITH + "SELECT count(DISTINCT topic) AS n_topics FROM assign", "A9")
def q_topic_count(spark, sf):
    return TP.topic_sizes(label_assign(text_docs(spark, sf))).agg(F.count(F.lit(1)).alias("n_topics"))


@register("renumber_topics", S.with_(*S.STAGE2, S.keep_first_sql("tc", "prepared", "cleaned_text"),
                                     f"docs AS ({_DOCS_SQL})") + """,
ch AS (SELECT doc_key, channel_name AS cl FROM docs),
per AS (SELECT cl, row_number() OVER (ORDER BY count(*) DESC, min(doc_key)) - 1 AS t FROM ch GROUP BY cl)
SELECT doc_key, CAST(t AS INTEGER) AS topic FROM ch JOIN per USING (cl)""".replace("\n,", "\n", 1).lstrip(), "W3 TM6")
def q_renumber_topics(spark, sf):
    d = text_docs(spark, sf).select("doc_key", F.col("channel_name").alias("topic"))
    return TP.renumber(d)


@register("min_topic_size", S.with_(*S.STAGE2, S.keep_first_sql("tc", "prepared", "cleaned_text"),
                                    f"docs AS ({_DOCS_SQL})") + f"""
SELECT doc_key, CAST(CASE WHEN count(*) OVER (PARTITION BY channel_name) >= {MIN_SIZE} THEN t ELSE -1 END AS INTEGER) AS topic
FROM (SELECT d.*, coalesce(TRY_CAST(regexp_extract(channel_name, '(\\d+)$', 1) AS INTEGER), 1000) AS t FROM docs d)""",
          "A7")
def q_min_topic_size(spark, sf):
    num = F.regexp_extract("channel_name", r"(\d+)$", 1).try_cast("int")
    a = text_docs(spark, sf).select("doc_key", F.coalesce(num, F.lit(1000)).alias("topic"))
    return TP.min_topic_size(a, MIN_SIZE)


@register("topic_term_counts", TOPIC_WITH + "SELECT topic, term, n FROM counts", "A8")
def q_topic_term_counts(spark, sf):
    docs = materialize(text_docs(spark, sf))
    return TP.topic_term_counts(docs, label_assign(docs))


@register("ctfidf", TOPIC_WITH + """
SELECT topic, term, n, round(tf, 8) AS tf, round(idf, 8) AS idf, round(ctfidf, 8) AS ctfidf FROM weights""", "M7 TM9")
def q_ctfidf(spark, sf):
    _, _, w, _ = model_tables(spark, sf)
    return w.select("topic", "term", "n", *[F.round(c, 8).alias(c) for c in ("tf", "idf", "ctfidf")])


@register("topic_terms", TOPIC_WITH + """
SELECT t.topic, t.rank, t.term, round(t.ctfidf, 8) AS ctfidf, r.name FROM top t JOIN rep r USING (topic)""",
          "T4 W4 TM10")
def q_topic_terms(spark, sf):
    _, _, w, _ = model_tables(spark, sf)
    top = TP.top_terms(w)
    rep = TP.representation(w).select("topic", "name")
    return top.join(rep, "topic").select("topic", F.col("rank").cast("bigint").alias("rank"), "term",
                                         F.round("ctfidf", 8).alias("ctfidf"), "name")


@register("representative_docs", TOPIC_WITH + """
SELECT topic, rank, doc_key, round(similarity, 8) AS similarity FROM rdocs""", "T5 W5 TM11 M5")
def q_representative_docs(spark, sf):
    docs, assign, w, dt = model_tables(spark, sf)
    r = TP.representative_docs(TP.doc_similarity(docs, assign, w, dt=dt))
    return r.select("topic", F.col("rank").cast("bigint").alias("rank"), "doc_key",
                    F.round("similarity", 8).alias("similarity"))


_INFO_SQL = TOPIC_WITH + """
SELECT s.topic, s.count, r.name, array_to_string(r.representation, ', ') AS representation,
       array_to_string(d.keys, '|') AS representative_docs
FROM (SELECT topic, count(*) AS count FROM assign GROUP BY topic) s
LEFT JOIN rep r USING (topic)
LEFT JOIN (SELECT topic, list(doc_key ORDER BY rank) AS keys FROM rdocs GROUP BY topic) d USING (topic)"""


def _info(spark, sf):
    docs, assign, w, dt = model_tables(spark, sf)
    rd = materialize(TP.representative_docs(TP.doc_similarity(docs, assign, w, dt=dt)))
    return docs, assign, w, rd, materialize(TP.topic_info(assign, w, rd, docs))


@register("topic_info", _INFO_SQL, "TM14 T3 S8 A6")
def q_topic_info(spark, sf):
    *_, info = _info(spark, sf)
    return info.select("topic", "count", "name", F.array_join("representation", ", ").alias("representation"),
                       F.array_join("representative_keys", "|").alias("representative_docs"))


@register("document_info", TOPIC_WITH + """
SELECT a.doc_key, d.text AS document, a.topic, r.name, array_to_string(r.representation, ' - ') AS top_n_words,
       CAST(CASE WHEN a.topic = -1 THEN 0.0 ELSE 1.0 END AS DOUBLE) AS probability, rd.doc_key IS NOT NULL AS representative_document
FROM assign a JOIN docs d USING (doc_key) LEFT JOIN rep r USING (topic) LEFT JOIN rdocs rd USING (doc_key)""",
          "TM15 J5 S9")
def q_document_info(spark, sf):
    docs, assign, w, rd, info = _info(spark, sf)
    out = TP.document_info(docs, assign, info, rd)
    return out.select("doc_key", "document", "topic", "name", "top_n_words", "probability", "representative_document")


@register("model_roundtrip", TOPIC_WITH + """
SELECT 'ctfidf' AS part, count(*) AS n_rows, round(sum(ctfidf), 6) AS checksum FROM weights
UNION ALL SELECT 'topics', count(*), sum(count) FROM (SELECT topic, count(*) AS count FROM assign GROUP BY topic)""",
          "S10")
def q_model_roundtrip(spark, sf):
    docs, assign, w, _ = model_tables(spark, sf)
    back = roundtrip_model({"ctfidf": w, "topics": TP.topic_sizes(assign)})
    return (back["ctfidf"].agg(F.lit("ctfidf").alias("part"), F.count(F.lit(1)).alias("n_rows"),
                               F.round(F.sum("ctfidf"), 6).alias("checksum"))
            .unionByName(back["topics"].agg(F.lit("topics").alias("part"), F.count(F.lit(1)).alias("n_rows"),
                                            F.sum("count").cast("double").alias("checksum"))))


_NEW_POSTS = (
    S.POSTS,
    f"""nterms AS (SELECT post_id, term, count(*) AS n FROM (
          SELECT post_id, unnest({S.tokens_sql("title || ' ' || selftext")}) AS term FROM posts) GROUP BY ALL)""",
    "nx AS (SELECT post_id, term, n * idf AS x FROM nterms JOIN (SELECT DISTINCT term, idf FROM weights) USING (term))",
    "nlen AS (SELECT post_id, sqrt(sum(x * x)) AS len FROM nx GROUP BY post_id)",
    """tlen AS (SELECT topic, sqrt(sum(ctfidf * ctfidf)) AS len FROM weights WHERE topic <> -1 GROUP BY topic)""",
    """near AS (SELECT post_id, topic, sum(x * ctfidf / tlen.len) AS s FROM nx JOIN weights USING (term) JOIN tlen USING (topic)
          WHERE tlen.len > 0 GROUP BY post_id, topic)""",
    """best AS (SELECT post_id, topic, s FROM near
          QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY round(s, 8) DESC, topic) = 1)""",
)


@register("model_transform", S.with_(*S.STAGE2, S.keep_first_sql("tc", "prepared", "cleaned_text"),
                                     *S.topic_ctes(_DOCS_SQL, _ASSIGN_SQL), *_NEW_POSTS) + """
SELECT p.post_id, CAST(coalesce(CASE WHEN s > 0 THEN topic END, -1) AS INTEGER) AS topic,
       round(coalesce(CASE WHEN s > 0 THEN s / l.len END, 0), 6) AS similarity
FROM posts p LEFT JOIN best b USING (post_id) LEFT JOIN nlen l USING (post_id)""", "S8 S9 S10 TM14")
def q_model_transform(spark, sf):
    """Topics of the messages, stored under a version and loaded again, assigned to posts the model never saw."""
    docs, assign, w, rd, info = _info(spark, sf)
    path = version_path(scratch_path(spark, "models"), "text_v1")
    DensityTopicsModel({"topic_info": info, "weights": w,
                        "docs_topic_info": TP.document_info(docs, assign, info, rd)}).save(path)
    new = TB.posts(spark, sf).select("post_id", F.concat_ws(" ", "title", "selftext").alias("text"))
    out = DensityTopicsModel.load(path).transform(new)
    return out.select("post_id", "topic", F.round("similarity", 6).alias("similarity"))
