"""Toxicity scores of deobfuscated text: noisy channel, Viterbi decoding, lexicon.

1. A character language model (trigrams backed off to bigrams) is counted over
   the words of all documents, in hashed tables of fixed size that tasks sum
   up locally and Spark adds.
2. A token that looks disguised (letters mixed with look-alike signs, letters
   repeated three times or more, letters spaced out) becomes a lattice: each
   sign may be one of the letters it stands for or nothing, each repetition
   may be one or two letters.  Viterbi search under the language model and the
   channel's costs gives the restored word.
3. Words and their 4- to 6-letter parts get log-odds weights from labelled
   documents, kept only where clearly above chance; a document's strongest
   words feed a logistic regression fitted on other labelled documents.

Labels are read from at most about ``SAMPLE_DOCS`` rows of the training folds
(a parameter); everything else covers all documents.  Labels, language, source
and id never enter a score.

Defined cases: null and empty texts have no words and get the score of the
intercept; null or repeated labels are dropped or merged (1 wins); without
labelled rows of both kinds every score is 0; repeated documents are scored row by
row; other columns are ignored by the report and kept by ``drop_toxic``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm.common import arrow_rows, read_table

THRESHOLD = 0.3
SAMPLE_DOCS = 20_000
MAX_FEATURES = 20_000
MIN_Z = 3.0
TOP_WORDS = 10
CACHE_ENTRIES = 200_000
#: Features of remembered tokens, and features counted, that a task holds at most.
CACHE_FEATURES, COUNTED_FEATURES = 2_000_000, 700_000
#: Rows that are turned into Python objects at once, and different tokens whose letters are counted together.
ROWS, COUNTED_TOKENS = 1024, 100_000
#: Marks around a word that no disguise uses.
MARKS = ".,;:!?\"'()"
LM_BITS = 18

#: The letters each look-alike sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "{": "c", "<": "c", "€": "e", "£": "l", "¥": "y",
    "#": "h", "%": "", "&": "", "*": "", ".": "", "-": "", "_": "", "~": "", "^": "", "'": "", "/": "", "\\": "",
    ",": "", ":": "", ";": "", "=": "",
}
COST_LETTER, COST_DROP, COST_SINGLE, COST_DOUBLE, COST_SAME = 1.0, 8.0, 0.5, 1.5, 0.0
_WORD = re.compile(r"[^\W\d_]+")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


#: Longer disguised tokens are decoded in pieces of so many signs.
DECODED = 256


def _edge(signs) -> int:
    """How many signs at the start of ``signs`` are punctuation, or runs of three or more of @, $ or _."""
    n = 0
    for sign, run in groupby(signs):
        size = sum(1 for _ in run)
        if (size < 3 if sign in "@$_" else sign.isalnum()):
            break
        n += size
    return n


def core_of(token: str) -> str:
    """A token without what stands around it."""
    token = token[_edge(token):]
    return token[:len(token) - _edge(reversed(token))]


def _slot(*codes) -> np.ndarray:
    """Hashed table index of two or three code points."""
    with np.errstate(over="ignore"):
        h = np.uint64(len(codes)) * _C
        for c in codes:
            h = (h ^ c) * _A
            h ^= h >> np.uint64(29)
        return (h * _B) >> np.uint64(64 - LM_BITS)


def count_words(words: Counter, pairs: np.ndarray, triples: np.ndarray) -> None:
    """Add the letter pairs and triples of weighted words to the hashed tables."""
    if not words:
        return
    text = "".join(f"^^{w}$" for w in words)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype("uint64")
    sizes = np.fromiter((len(w) + 3 for w in words), "int64", len(words))
    weight = np.repeat(np.fromiter(words.values(), "int64", len(words)), sizes)
    inside = np.ones(len(code), dtype=bool)
    inside[np.cumsum(sizes)[:-1]] = False
    two = np.flatnonzero(inside[1:])
    pairs += np.bincount(_slot(code[two], code[two + 1]).astype("int64"), weight[two], len(pairs)).astype("int64")
    three = two[(two > 0) & inside[two]] - 1
    triples += np.bincount(_slot(code[three], code[three + 1], code[three + 2]).astype("int64"), weight[three],
                           len(triples)).astype("int64")


def words_in(tokens: Counter) -> Counter:
    """The words of counted tokens."""
    words: Counter = Counter()
    for token, times in tokens.items():
        for word in (token,) if token.isalpha() else _WORD.findall(token):
            words[word] += times
    return words


def character_counts(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Letter pairs and triples of all documents: two tables of 2^18 counts.

    Each task adds its words into its own tables and sends them in 64 slices;
    Spark sums each slice, so what is moved is a fixed size per task."""
    size, slices = 1 << LM_BITS, 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((2, size), dtype="int64")
        # no word reaches over white space, so a token is taken apart once however often it occurs
        tokens: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                for t in batch.column(0).slice(at, ROWS).to_pylist():
                    if t:
                        tokens.update(t.lower().split())
                if len(tokens) > COUNTED_TOKENS:
                    count_words(words_in(tokens), both[0], both[1])
                    tokens.clear()
        count_words(words_in(tokens), both[0], both[1])
        flat = both.reshape(slices, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()),
                                          pa.array([x.tobytes() for x in flat], pa.binary())], ["part", "counts"])

    def total(part: pd.DataFrame) -> pd.DataFrame:
        added = sum(np.frombuffer(x, "int64") for x in part["counts"])
        return pd.DataFrame({"part": part["part"].iloc[:1], "counts": [added.tobytes()]})

    partial = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(count, "part int, counts binary")
    rows = partial.groupBy("part").applyInPandas(total, "part int, counts binary").collect()
    flat = {r["part"]: np.frombuffer(r["counts"], "int64") for r in rows}
    whole = np.concatenate([flat.get(k, np.zeros(2 * size // slices, "int64")) for k in range(slices)])
    return whole[:size], whole[size:]


class Restorer:
    """Viterbi decoding of disguised tokens under a character language model."""

    def __init__(self, pairs: np.ndarray, triples: np.ndarray):
        self.pairs, self.triples = pairs, triples
        self._known: dict[tuple[str, str], float] = {}

    def cost(self, before: str, letter: str) -> float:
        """Negative log probability of ``letter`` after the last two letters."""
        found = self._known.get((before, letter))
        if found is None:
            a, b, c = (np.uint64(ord(x)) for x in before + letter)
            two, three = float(self.pairs[int(_slot(b, c))]), float(self.triples[int(_slot(a, b, c))])
            context = float(self.pairs[int(_slot(a, b))])
            single = (two + 0.5) / (float(self._after(b)) + 15.0)
            found = self._known[before, letter] = -float(np.log((three + 5.0 * single) / (context + 5.0)))
        return found

    def _after(self, b) -> float:
        seen = self._known.get(("", chr(int(b))))
        if seen is None:
            letters = np.array([ord(x) for x in "abcdefghijklmnopqrstuvwxyz$"], dtype="uint64")
            seen = float(self.pairs[_slot(np.full(len(letters), b), letters).astype("int64")].sum())
            self._known["", chr(int(b))] = seen
        return seen

    def decode(self, token: str) -> str:
        """The cheapest letters behind a disguised token."""
        best: dict[str, tuple[float, str]] = {"^^": (0.0, "")}
        for sign, run in groupby(token):
            count = len(list(run))
            options: dict[str, float] = {}
            for letter in LOOKALIKES.get(sign, sign if sign.isalpha() else ""):
                price = COST_SAME if letter == sign else COST_LETTER
                options[letter] = price + (0.0 if count == 1 else COST_SINGLE)
                if count > 1:
                    options[letter * 2] = price + (0.0 if count == 2 else COST_DOUBLE)
            if sign in LOOKALIKES or not sign.isalpha():
                options[""] = 0.5 if not LOOKALIKES.get(sign) else COST_DROP * count
            step: dict[str, tuple[float, str]] = {}
            for state, (paid, text) in best.items():
                for letters, price in options.items():
                    now, cost = state, paid + price
                    for x in letters:
                        cost += self.cost(now, x)
                        now = now[1] + x
                    if now not in step or cost < step[now][0]:
                        step[now] = (cost, text + letters)
            best = step
        return min((paid + self.cost(state, "$"), text) for state, (paid, text) in best.items())[1]

    def words(self, token: str) -> list[str]:
        """The words a token stands for: as written, and restored if it looks disguised."""
        bare = token.strip(MARKS)
        if bare.isalpha() and not _TRIPLE.search(bare):
            return [bare]
        plain = _WORD.findall(token)
        core = core_of(token)
        letters = sum(map(len, plain))
        if letters and (_TRIPLE.search(core) or (not core.isalpha() and any(
                LOOKALIKES.get(x) for x in core)) or (len(plain) > 2 and letters <= 1.5 * len(plain))):
            restored = "".join(self.decode(core[at:at + DECODED]) for at in range(0, len(core), DECODED))
            return [*plain, *_WORD.findall(restored)]
        return plain


def tokens_of(text: str | None) -> set[str]:
    """Distinct tokens, with runs of three or more single signs joined to one."""
    if not text:
        return set()
    tokens = text.lower().split()
    singles = [i for i, t in enumerate(tokens) if len(t) == 1]
    distinct = set(tokens)
    if len(singles) > 2:
        start = 0
        for k in range(1, len(singles) + 1):
            if k == len(singles) or singles[k] != singles[k - 1] + 1:
                if k - start > 2:
                    distinct.add("".join(tokens[singles[start]:singles[k - 1] + 1]))
                start = k
    return distinct


def features_of(word: str) -> set[str]:
    """A word between marks and its parts of 4 to 6 signs."""
    w = f"^{word}$"
    return {w} | {w[i:i + k] for k in (4, 5, 6) for i in range(len(w) - k + 1)}


def _features(batches: Iterator[pa.RecordBatch], tables) -> Iterator[pa.RecordBatch]:
    """(feature, toxic documents, other documents) of a task.

    A feature is held once, under a number; tokens remember numbers."""
    restorer, kept, held = Restorer(*tables.value), {}, 0
    numbers: dict[str, int] = {}
    counts = np.zeros((2, 1024), dtype="int64")
    place = np.zeros(1024, dtype="int64")
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            for t, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own = []
                for token in tokens_of(t):
                    found = kept.get(token)
                    if found is None:
                        names = set().union(*map(features_of, restorer.words(token)))
                        found = np.array([numbers.setdefault(x, len(numbers)) for x in names], dtype="int32")
                        if held + len(found) > CACHE_FEATURES or len(kept) >= CACHE_ENTRIES:
                            kept.clear()
                            held = 0
                        kept[token], held = found, held + len(found)
                    own.append(found)
                if own:
                    if len(numbers) > len(place):
                        more = max(len(numbers), 2 * len(place)) - len(place)
                        counts, place = np.pad(counts, ((0, 0), (0, more))), np.pad(place, (0, more))
                    every = np.concatenate(own)
                    # of equal numbers the last one written stays, so each counts once
                    order = np.arange(len(every))
                    place[every] = order
                    counts[int(toxic), every[place[every] == order]] += 1
                if len(numbers) > COUNTED_FEATURES:
                    yield _counted(numbers, counts)
                    numbers, kept, held = {}, {}, 0
                    # what was given out may still hold the old table
                    counts = np.zeros_like(counts)
    yield _counted(numbers, counts)


def _counted(numbers: dict[str, int], counts: np.ndarray) -> pa.RecordBatch:
    miss, hit = counts[:, :len(numbers)]
    return pa.RecordBatch.from_arrays([pa.array(list(numbers), pa.string()), pa.array(hit), pa.array(miss)], ["feature", "hit", "miss"])


class Scorer:
    """Strongest words of a text, from feature weights; remembers tokens."""

    def __init__(self, tables, weights: dict[str, float]):
        self.restorer, self.weights = Restorer(*tables), weights
        # a part of five or six signs is looked up only where one that weighs begins with the same four
        self.heads = {x[:4] for x in weights}
        self.kept: dict[str, float] = {}

    def _token(self, token: str) -> float:
        best, get, heads = 0.0, self.weights.get, self.heads
        for word in self.restorer.words(token):
            w = f"^{word}$"
            n = len(w)
            found = get(w)
            if found:
                best = max(best, found)
            for i in range(n - 3):
                if w[i:i + 4] in heads:
                    for k in range(4, min(6, n - i) + 1):
                        found = get(w[i:i + k])
                        if found and found > best:
                            best = found
        if len(self.kept) >= CACHE_ENTRIES:
            self.kept.clear()
        if len(token) <= 40:
            self.kept[token] = best
        return best

    def signals(self, text: str | None) -> list[float]:
        kept = self.kept
        found = sorted((s for s in (kept[t] if t in kept else self._token(t) for t in tokens_of(text)) if s),
                       reverse=True)[:TOP_WORDS]
        return [found[0] if found else 0.0, sum(found[1:3]), sum(found[3:])]


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights (intercept last) of a penalized logistic regression by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.diag([penalty] * (x.shape[1] - 1) + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 4; 2 is held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))


def learn(docs: DataFrame, labelled: DataFrame, corpus: DataFrame, sample_docs: int = SAMPLE_DOCS):
    """(language model tables, feature weights, regression) as broadcast variables' values.

    ``labelled`` has doc_id and toxic; rows of fold 2 are never read.  Three
    quarters of the sampled rows weigh features, the rest fit the regression.
    """
    sc = docs.sparkSession.sparkContext
    tables = sc.broadcast(character_counts(corpus))
    truth = labelled.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")) \
        .where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & (fold("id") != 2)) \
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    rows = truth.count()
    share = min(1.0, sample_docs / max(1, rows))
    sampled = truth.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * share))
    slim = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("t"))
    train = slim.join(F.broadcast(sampled), "id").withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(4)))
    weigh = train.where("part < 3").select("t", "toxic")
    n = {r["toxic"]: r["count"] for r in weigh.groupBy("toxic").count().collect()}
    hits, misses = n.get(1, 0), n.get(0, 0)
    if not hits or not misses:
        return tables, {}, np.zeros(4)
    counted = weigh.mapInArrow(lambda b: _features(b, tables), "feature string, hit long, miss long") \
        .groupBy("feature").agg(F.sum("hit").alias("hit"), F.sum("miss").alias("miss")).where("hit >= 3")
    odds = F.log((F.col("hit") + 0.5) / (hits - F.col("hit") + 0.5)) \
        - F.log((F.col("miss") + 0.5) / (misses - F.col("miss") + 0.5))
    error = F.sqrt(1 / (F.col("hit") + 0.5) + 1 / (F.col("miss") + 0.5))
    strong = counted.select("feature", odds.alias("odds"), error.alias("error")) \
        .where(F.col("odds") / F.col("error") > MIN_Z).select("feature", (F.col("odds") - F.col("error")).alias("w")) \
        .orderBy(F.desc("w"), "feature").limit(MAX_FEATURES)
    weights = {r["feature"]: r["w"] for r in strong.collect()}
    shared = sc.broadcast(weights)

    def signal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(tables.value, shared.value)
        for batch in batches:
            found = [scorer.signals(t) for at in range(0, batch.num_rows, ROWS) for t in batch.column(0).slice(at, ROWS).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.float64()) for k in range(3)]
                                             + [batch.column(1)], ["a", "b", "c", "toxic"])
    rest = train.where("part = 3").select("t", "toxic").mapInArrow(signal, "a double, b double, c double, toxic int") \
        .limit(sample_docs).toPandas()
    if rest["toxic"].nunique() < 2:
        return tables, weights, np.array([1.0, 0.5, 0.1, -4.0])
    return tables, weights, fit_logistic(rest[["a", "b", "c"]].to_numpy(), rest["toxic"].to_numpy(dtype=float))


def scores(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` with ``__score``, from the text alone."""
    tables, weights, line = model
    shared = docs.sparkSession.sparkContext.broadcast((weights, line))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, w = shared.value
        scorer = Scorer(tables.value, own)
        for part in batches:
            x = np.array([scorer.signals(t) for t in part], dtype="float64").reshape(len(part), 3)
            z = np.clip(x @ w[:3] + w[3], -40, 40)
            yield pd.Series(1 / (1 + np.exp(-z)) if len(own) else np.zeros(len(part)))
    return docs.withColumn("__score", score(F.col(text).cast("string")))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: held_out, score and predicted."""
    slim = docs.select("doc_id", "text")
    return scores(slim, learn(slim, labels, slim)).select(
        "doc_id", (fold() == 2).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns."""
    scored = scores(docs, learn(docs, labels, docs))
    return scored.where(F.col("__score") < threshold).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
