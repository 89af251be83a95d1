"""Document quality rules with host-level verdicts, in DataFrame functions only.

Base counts come from array functions inside each row, so nothing is exploded
or shuffled per word; the per-document digest is written once.  Rule failures
are summed by host (with map-side partial sums, so a host with a third of all
rows costs one row per task), the hosts' rates are shrunk towards an empirical
beta prior whose two parameters fit the hosts' mean and variance, and the
verdict is joined back to the documents.

Defined cases: null and empty texts have no words and fail the base rule; a
null host is a host of its own; repeated rows count as often as they occur; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm.common import materialize, read_table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
MAX_HOST_RATE = 0.8

PLACE_BITS = 24

_SPACE = "\\x20\\x09-\\x0D"
_SYMBOL = "[#*$%&|<>]"


def _repeat_words(docs: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from the word array ``w``: distinct positions inside
    3-word windows that occur at least twice.

    Each window becomes one long, 40 bits of its hash above its position, and
    the longs are sorted as primitives; windows whose hash bits meet are
    candidates, and only those are compared as texts, so hash collisions (and
    positions beyond 24 bits, which merely make more candidates) change nothing.
    """
    mask = (1 << PLACE_BITS) - 1
    hashed = docs.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    keyed = hashed.withColumn("k", F.sort_array(F.slice(F.transform(
        "h", lambda x, i: F.xxhash64(x, F.get("h", i + 1), F.get("h", i + 2)).bitwiseAND(~mask)
        .bitwiseOR(i.cast("long").bitwiseAND(mask))), 1, F.greatest(F.size("w") - 2, F.lit(0))))).drop("h")
    near = keyed.withColumn("k", F.transform(F.filter("k", lambda x, j: (
        F.coalesce(F.shiftright(x, PLACE_BITS) == F.shiftright(F.get("k", j - 1), PLACE_BITS), F.lit(False))
        | F.coalesce(F.shiftright(x, PLACE_BITS) == F.shiftright(F.get("k", j + 1), PLACE_BITS), F.lit(False)))),
        lambda x: x.bitwiseAND(mask).cast("int")))
    places = F.when(F.size("w") <= mask, F.col("k")).otherwise(F.sequence(F.lit(0), F.size("w") - 3))
    grams = near.withColumn("k", places).withColumn("s", F.array_sort(F.transform("k", lambda i: F.struct(
        F.concat_ws(" ", F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("g"), i.alias("i"))))) \
        .drop("w", "k")
    same = grams.withColumn("p", F.transform(F.filter("s", lambda x, j: (
        F.coalesce(x["g"] == F.get("s", j - 1)["g"], F.lit(False))
        | F.coalesce(x["g"] == F.get("s", j + 1)["g"], F.lit(False)))), lambda x: x["i"])).drop("s")
    hit = F.flatten(F.transform("p", lambda i: F.array(i, i + 1, i + 2)))
    return same.withColumn("n_repeat_words", F.size(F.array_distinct(hit)).cast("long")).drop("p")


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per document: host, word, symbol, line and repetition counts, and the base verdict."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    counted = slim.select(
        "doc_id", "host", F.array_remove(F.split("t", f"[{_SPACE}]+"), "").alias("w"),
        F.regexp_count("t", F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{_SPACE}]")).alias("l"))
    sized = counted.withColumns({
        "n_words": F.size("w").cast("long"), "word_chars": F.length(F.array_join("w", "")).cast("long"),
        "n_lines": F.size("l").cast("long"),
        "n_dup_lines": (F.size("l") - F.size(F.array_distinct("l"))).cast("long")}).drop("l")
    return _repeat_words(sized).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def rule_failed() -> Column:
    """Any document rule: the base rules, too many symbols, or too many repeated lines."""
    return (F.col("base_failed") | (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"))
            | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")))


def host_rates(measured: DataFrame) -> DataFrame:
    """Per host: documents, failures, and the failure rate shrunk by the beta prior.

    The prior's mean is the pooled rate, its strength comes from the variance
    of the hosts' rates; without variance the strength is that of one document.
    """
    hosts = materialize(measured.groupBy("host").agg(F.count("*").alias("host_docs"),
                                                     F.sum(rule_failed().cast("long")).alias("host_failures")), "hosts")
    rate = F.col("host_failures") / F.col("host_docs")
    prior = hosts.agg((F.sum("host_failures") / F.sum("host_docs")).alias("m"), F.var_pop(rate).alias("v")).first()
    mean, spread = prior["m"] or 0.0, prior["v"] or 0.0
    strength = max(1.0, mean * (1 - mean) / spread - 1) if spread > 0 else 1.0
    return hosts.withColumn("host_rate", (F.col("host_failures") + mean * strength) / (F.col("host_docs") + strength))


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
             max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Per document its counts, its host's shrunk rate, and ``kept``: false if the
    base rules fail or the host's shrunk failure rate is over ``max_host_rate``."""
    measured = materialize(measures(docs, doc_id, text, host), "measures")
    hosts = host_rates(measured).select(F.col("host").alias("__host"), "host_rate")
    joined = measured.join(hosts, F.col("host").eqNullSafe(F.col("__host")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate)).drop("__host")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdicts of all documents; the host is ``source``."""
    return verdicts(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3)),
twice AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) >= 2),
pos AS (SELECT doc_id, count(*) AS n FROM (
          SELECT DISTINCT g.doc_id, unnest(range(g.p, g.p + 3)) AS at
          FROM g JOIN twice ON g.doc_id = twice.doc_id AND g.g = twice.g) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, d.source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(pos.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
f AS (SELECT *, base_failed OR 100 * n_symbols > {MAX_SYMBOL_PERCENT} * word_chars
                OR 100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines AS failed FROM b),
h AS (SELECT source, count(*) AS n, sum(CASE WHEN failed THEN 1 ELSE 0 END) AS k FROM f GROUP BY source),
prior AS (SELECT sum(k) / sum(n) AS mean, var_pop(k / n) AS spread FROM h),
strength AS (SELECT mean, CASE WHEN spread > 0 THEN greatest(1.0, mean * (1 - mean) / spread - 1) ELSE 1.0 END AS s
             FROM prior),
rate AS (SELECT source, (k + mean * s) / (n + s) AS r FROM h, strength)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r <= {MAX_HOST_RATE} AS kept
FROM f JOIN rate ON f.source IS NOT DISTINCT FROM rate.source
"""
