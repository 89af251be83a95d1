"""Topic tables from topic assignments: sizes, renumbering, class-based
TF-IDF, top terms, representative documents, topic / document info.

Inputs are long tables so every step is a join or an aggregate:

- ``docs``    (doc_key, text)
- ``assign``  (doc_key, topic)          topic -1 = outlier
- ``weights`` (topic, term, ctfidf)     from :func:`ctfidf`

c-TF-IDF per class c and term t (class-based TF-IDF of Grootendorst 2022):
``tf(t,c) / sum_t tf(t,c) * ln(1 + A / f(t))`` with ``A`` the integer part
of the mean number of words per class and ``f(t)`` the corpus count of t.

Scale notes: token counts are made where a document's text is, so only
texts are shuffled for them; the per-topic top-k filters become ``WindowGroupLimit``
below the shuffle; the doc-term x topic-term join is many-to-one on
``(topic, term)`` so a hot pair is split by AQE's skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopy.functions.text import tokens
from canopy.operators.util import materialize

OUTLIER = -1
TOP_N_WORDS = 10
NAME_WORDS = 4
N_REPR_DOCS = 3
SCORE_PLACES = 8


def dense_ids(df: DataFrame, col: str, out: str, start: int = 0) -> DataFrame:
    """Dictionary-encode ``col`` in sorted order.  The distinct values are
    numbered on their own table with a range-partitioned dense index (no
    single-partition window) and joined back."""
    from canopy.operators.records import global_index
    dic = global_index(df.select(col).distinct(), [col], "_ix")
    dic = dic.select(col, (F.col("_ix") + start).cast("int").alias(out))
    return df.join(dic, col, "left")


def topic_sizes(assign: DataFrame) -> DataFrame:
    """Documents per topic (outliers included)."""
    return assign.groupBy("topic").agg(F.count(F.lit(1)).alias("count"))


def min_topic_size(assign: DataFrame, min_size: int, key: str = "doc_key") -> DataFrame:
    """Clusters smaller than ``min_size`` become outliers (-1)."""
    sizes = assign.where(F.col("topic").cast("string") != F.lit(str(OUTLIER))).groupBy("topic").agg(F.count(F.lit(1)).alias("_n"))
    j = assign.join(sizes, "topic", "left")
    # the id keeps its type: a cluster named by a long or a string stays what it is
    return j.select(key, F.when(F.col("_n") >= min_size, F.col("topic"))
                    .otherwise(F.lit(OUTLIER).cast(assign.schema["topic"].dataType)).alias("topic"))


def renumber(assign: DataFrame, key: str = "doc_key") -> DataFrame:
    """W3/TM6: topics renumbered 0.. by size (desc), ties by smallest member
    key; -1 stays -1.  Numbering runs on the per-topic table."""
    not_outlier = F.col("topic").cast("string") != F.lit(str(OUTLIER))
    per = (assign.where(not_outlier).groupBy("topic")
           .agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_k")))
    from canopy.operators.records import global_index
    per = global_index(per, [F.col("_n").desc(), F.col("_k")], "_ix").withColumn("_new", F.col("_ix").cast("int"))
    j = assign.join(per.select("topic", "_new"), "topic", "left")
    return j.select(key, F.coalesce("_new", F.lit(OUTLIER)).cast("int").alias("topic"))


def doc_terms(docs: DataFrame, key: str = "doc_key", text: str = "text", stored: bool = False) -> DataFrame:
    """F18 + per-document term counts: (doc_key, term, n).

    Texts are shuffled by document, not their terms.  The terms of a document are sorted and
    counted in its row, so a task holds the texts of its partition and no table of their terms.
    Of ``stored`` documents, a written table, only those of repeated keys are shuffled.
    """
    docs, met = docs.select(key, text), docs.select(key, text)
    if stored:
        repeated = materialize(docs.groupBy(key).agg(F.count("*").alias("_rows")).where("_rows > 1").select(key), "repeated")
        met = docs.join(repeated, key, "left_semi")
    texts = met.repartition(key).groupBy(key).agg(F.collect_list(text).alias("_texts"))
    if stored:
        texts = texts.unionByName(docs.join(repeated, key, "left_anti").select(key, F.array_compact(F.array(text)).alias("_texts")))
    # staged, so that the words are sorted once per row and not at every use
    words = texts.select(key, F.sort_array(F.flatten(F.transform("_texts", tokens))).alias("_w"))
    first = F.transform("_w", lambda w, i: F.when((i == 0) | (w != F.get("_w", i - 1)), i))
    placed = words.select(key, "_w", F.filter(first, lambda i: i.isNotNull()).alias("_at"))
    ends = lambda j: F.coalesce(F.get("_at", j + 1), F.size("_w"))
    runs = F.transform("_at", lambda i, j: F.struct(F.get("_w", i).alias("term"), (ends(j) - i).cast("bigint").alias("n")))
    return placed.select(key, F.explode(runs).alias("_r")).select(key, "_r.term", "_r.n")


def topic_term_counts(docs: DataFrame, assign: DataFrame, key: str = "doc_key", text: str = "text",
                      dt: DataFrame | None = None) -> DataFrame:
    """Bag of words per topic: (topic, term, n).  Pass ``dt`` (from
    :func:`doc_terms`) to reuse already tokenized documents."""
    dt = dt if dt is not None else doc_terms(docs, key, text)
    return (dt.join(assign.select(key, "topic"), key)
            .groupBy("topic", "term").agg(F.sum("n").alias("n")))


def ctfidf(counts: DataFrame) -> DataFrame:
    """M7/TM9: (topic, term, n) -> (topic, term, n, tf, idf, ctfidf).

    The counts are read four times, so they are written once."""
    counts = materialize(counts, "counts")
    per_topic = counts.groupBy("topic").agg(F.sum("n").alias("_topic_words"))
    avg = per_topic.select(F.floor(F.avg("_topic_words"))).scalar()
    freq = counts.groupBy("term").agg(F.sum("n").alias("_f"))
    j = counts.join(per_topic, "topic").join(freq, "term")
    tf = F.col("n") / F.col("_topic_words")
    idf = F.log(avg / F.col("_f") + 1.0)
    return j.select("topic", "term", "n", tf.alias("tf"), idf.alias("idf"), (tf * idf).alias("ctfidf"))


def top_terms(weights: DataFrame, k: int = TOP_N_WORDS) -> DataFrame:
    """The ``k`` best terms per topic by rounded score, then term."""
    w = Window.partitionBy("topic").orderBy(F.round("ctfidf", SCORE_PLACES).desc(), "term")
    return (weights.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("topic", "rank", "term", "ctfidf"))


def representation(weights: DataFrame, k: int = TOP_N_WORDS, name_words: int = NAME_WORDS) -> DataFrame:
    """TM10: (topic, representation array, name ``id_w1_w2_w3_w4``)."""
    top = top_terms(weights, k)
    agg = top.groupBy("topic").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_s"))
    rep = F.transform("_s", lambda s: s.getField("term"))
    return agg.select(
        "topic", rep.alias("representation"),
        F.concat_ws("_", F.col("topic").cast("string"), F.array_join(F.slice(rep, 1, name_words), "_")).alias("name"))


def doc_similarity(docs: DataFrame, assign: DataFrame, weights: DataFrame,
                   key: str = "doc_key", text: str = "text", dt: DataFrame | None = None) -> DataFrame:
    """Cosine between each document's c-TF-IDF vector and its topic's.

    The document vector is the fitted idf times the term counts (its length
    does not change a cosine).  Every term of a document is among the weights
    of its topic, so one join on (topic, term) brings idf and weight, and one
    sum by document gives product and norm.
    """
    dt = dt if dt is not None else doc_terms(docs, key, text)
    tnorm = weights.groupBy("topic").agg(F.sqrt(F.sum(F.col("ctfidf") * F.col("ctfidf"))).alias("_tn"))
    w = F.col("n") * F.col("idf")
    both = (dt.join(assign.select(key, "topic"), key)
            .join(weights.select("topic", "term", "idf", "ctfidf"), ["topic", "term"])
            .groupBy(key, "topic").agg(F.sum(w * F.col("ctfidf")).alias("_dot"), F.sqrt(F.sum(w * w)).alias("_dn")))
    scale = F.col("_dn") * F.col("_tn")
    return both.join(tnorm, "topic").select(
        key, "topic", F.when(scale > 0, F.col("_dot") / scale).otherwise(0.0).alias("similarity"))


def representative_docs(sim: DataFrame, k: int = N_REPR_DOCS, key: str = "doc_key") -> DataFrame:
    """W5/T5/TM11: top ``k`` documents per topic (every document scored)."""
    w = Window.partitionBy("topic").orderBy(F.round("similarity", SCORE_PLACES).desc(), key)
    return sim.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def topic_info(assign: DataFrame, weights: DataFrame, repr_docs: DataFrame, docs: DataFrame,
               key: str = "doc_key", text: str = "text") -> DataFrame:
    """TM14/T3: topic, count, name, representation, representative_docs."""
    sizes = topic_sizes(assign)
    rep = representation(weights)
    rd = (repr_docs.join(docs.select(key, text), key)
          .groupBy("topic").agg(F.sort_array(F.collect_list(F.struct("rank", key, text))).alias("_d")))
    rd = rd.select("topic", F.transform("_d", lambda s: s.getField(text)).alias("representative_docs"),
                   F.transform("_d", lambda s: s.getField(key)).alias("representative_keys"))
    return (sizes.join(rep, "topic", "left").join(rd, "topic", "left")
            .select(F.col("topic").cast("int").alias("topic"), "count", "name", "representation",
                    "representative_docs", "representative_keys"))


def document_info(docs: DataFrame, assign: DataFrame, info: DataFrame, repr_docs: DataFrame,
                  probability: DataFrame | None = None, key: str = "doc_key", text: str = "text") -> DataFrame:
    """TM15/J5: one row per document with its topic's name and words.

    ``info`` has one row per topic; AQE broadcasts it when it is small.
    """
    flag = repr_docs.select(key, F.lit(True).alias("representative_document"))
    out = (docs.select(key, F.col(text).alias("document")).join(assign, key)
           .join(info.select("topic", "name", F.array_join("representation", " - ").alias("top_n_words")),
                 "topic", "left")
           .join(flag, key, "left")
           .withColumn("representative_document", F.coalesce("representative_document", F.lit(False))))
    if probability is not None:
        out = out.join(probability.select(key, "probability"), key, "left")
    else:
        out = out.withColumn("probability", F.when(F.col("topic") == OUTLIER, 0.0).otherwise(1.0))
    return out
