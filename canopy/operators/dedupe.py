"""Keep-first deduplication (A2a-e) and the corpora built from it.

"First" is defined by a total order (``msg_date_dt, custom_id``) so the
result does not depend on file or partition order.  The plan is
``row_number() OVER (PARTITION BY keys ORDER BY order) = 1``; Spark turns
the filter into a ``WindowGroupLimit`` that runs *before* the shuffle as
well as after it, so a hot key (e.g. the NULL hash of every failed image,
possibly a third of all rows) is cut to one row per map task before it
reaches the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopy.functions.text import char_length, with_clean_text

ORDER = ("msg_date_dt", "custom_id")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER,
               null_key: str = "collapse") -> DataFrame:
    """Drop rows whose ``keys`` repeat, keeping the first by ``order``.

    ``null_key='collapse'`` treats NULL keys as equal (pandas semantics);
    ``'keep'`` keeps every row whose key has a NULL.
    """
    keys = list(keys)
    if null_key == "keep":
        # rows with a NULL key never enter the window, so they are no hot group
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        return keep_first(df.where(~any_null), keys, order).unionByName(df.where(any_null))
    if null_key != "collapse":
        raise ValueError("null_key must be 'collapse' or 'keep'")
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def cleaned_messages(src: DataFrame) -> DataFrame:
    """F5 over the message text; NULL text stays NULL."""
    return with_clean_text(src, "text", "cleaned_text")


def image_messages(clean: DataFrame) -> DataFrame:
    """Image messages with non-empty cleaned text (NULL -> '')."""
    # a filter on the cleaned text would be pushed below the cleaning and clean every text again
    some = F.filter(F.array(F.coalesce("cleaned_text", F.lit(""))), lambda t: char_length(t) > 0)
    return clean.where(F.col("msg_type") == "image").withColumn("cleaned_text", F.explode(some))


def message_level(df: DataFrame) -> DataFrame:
    """One row per ``custom_id``."""
    return keep_first(df, ["custom_id"])


def base_corpus(df: DataFrame) -> DataFrame:
    """Unique (text, image hash) pairs."""
    return keep_first(df, ["cleaned_text", "dhash"])


def text_corpus(df: DataFrame) -> DataFrame:
    """Unique cleaned text."""
    return keep_first(df, ["cleaned_text"])


def image_corpus(df: DataFrame) -> DataFrame:
    """A2d: unique image hash (all NULL hashes collapse to one row)."""
    return keep_first(df, ["dhash"])


def multimodal_corpus(df: DataFrame, image_first: bool = True) -> DataFrame:
    """A2e: image dedupe, then text dedupe of what is left (order matters)."""
    if image_first:
        return keep_first(keep_first(df, ["dhash"]), ["cleaned_text"])
    return keep_first(keep_first(df, ["cleaned_text"]), ["dhash"])


CORPORA = {
    "base": base_corpus,
    "text": text_corpus,
    "image": image_corpus,
    "multimodal": multimodal_corpus,
}


def prepared(src: DataFrame) -> DataFrame:
    """Stage-2 input shared by all corpora: clean -> image filter -> A2a."""
    return message_level(image_messages(cleaned_messages(src)))


MODALITY_ALIASES = {"img": "image", "mm": "multimodal", "txt": "text"}


def corpus(src: DataFrame, name: str) -> DataFrame:
    """Pick a corpus by name (aliases ``img``/``mm`` accepted)."""
    return CORPORA[MODALITY_ALIASES.get(name, name)](prepared(src))


def route(src: DataFrame, mode: str, modality: str) -> DataFrame:
    """``base`` mode reads the base corpus for every modality;
    ``dedupe`` mode reads the corpus deduplicated for that modality."""
    if mode == "base":
        return corpus(src, "base")
    if mode in ("dedupe", "dedup"):
        return corpus(src, modality)
    raise ValueError(f"unknown mode {mode!r}")


def corpus_sizes_from(base: DataFrame) -> DataFrame:
    """A3 over an already prepared (and ideally materialized) frame."""
    parts = [base.select(F.lit("prepared").alias("corpus"))]
    parts += [fn(base).select(F.lit(n).alias("corpus")) for n, fn in CORPORA.items()]
    parts.append(multimodal_corpus(base, image_first=False)
                 .select(F.lit("multimodal_text_first").alias("corpus")))
    tagged = parts[0]
    for p in parts[1:]:
        tagged = tagged.unionByName(p)
    return tagged.groupBy("corpus").agg(F.count(F.lit(1)).alias("n_rows"))


def corpus_sizes(src: DataFrame) -> DataFrame:
    """A3: row count of every corpus, plus the text-then-image order."""
    return corpus_sizes_from(prepared(src))
