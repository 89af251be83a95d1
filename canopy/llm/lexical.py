"""Ranked lexical search with range-maximum sparse tables per posting list.

1. One pass over the documents counts, where they lie, the terms that the items
   ask for; a slim row per document (length, term numbers, counts) is written.
2. From that table: number and length of documents, document frequencies (sums
   per task before the shuffle, at most one row per asked term after it).
3. A task takes its slim rows in blocks, orders a block's documents by length and
   lays out its postings by term.  Impacts get one sparse table of maxima per block
   (a query never leaves a posting list).  For an item, intervals of documents wait
   in a heap under the sum of the maxima of its terms' ranges.  The highest one is
   split at the document of the largest impact: the cell of ``CELL`` documents
   around it is scored in full, the rests to both sides go back under new bounds.
   The search ends when no bound reaches the item's tenth score; that score is
   carried from block to block, so later blocks are mostly bounded away.
4. A task gives ten rows per item; one ranking per item over these is the result.

Items are broadcast in blocks of at most ``ITEM_CHARS`` characters, so a benchmark
of any size is searched whole, one pass per block.  Every document is searched; no
posting, document or candidate is capped.

Defined cases: null texts have no terms; documents without terms count nowhere;
rows of one item id are one item, whose terms are those of all its rows; a null item
id is an item; items without terms, or none of whose terms has weight in a document,
give no rows; documents of one id each count and rank for themselves, null ids
first among equal scores; texts of any length are read in pieces cut between
terms; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from canopy.llm.common import materialize, read_table

TOP = 10
CELL = 256
#: Postings and documents of one block.
BLOCK_POSTINGS, BLOCK_DOCS = 1 << 19, 1 << 15
ITEM_CHARS = 4_000_000
PIECE = 1 << 20

#: Bytes of a term stay, A-Z in lower case; all others become a space.
_TABLE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())

COUNTED = "doc_id {id}, n long, terms array<int>, counts array<long>"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Lists of the terms of a text, in pieces."""
    at = 0
    while at < len(text):
        end = at + PIECE
        piece = text[at:end].translate(_TABLE)
        if end < len(text):
            # go on to the end of the term that the cut meets
            while not piece.endswith(b" ") and end < len(text):
                more = text[end:end + 4096].translate(_TABLE)
                stop = more.find(b" ")
                piece += more[:stop + 1] if stop >= 0 else more
                end += stop + 1 if stop >= 0 else len(more)
        yield piece.split()
        at = end


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of documents that have terms: their length, and the asked terms."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, sizes, ends, terms, counts = [], [], [0], [], []
            for i, text in enumerate(batch["text"]):
                n, found = 0, Counter()
                buffer = text.as_buffer()
                if buffer is not None:
                    for words in terms_of(memoryview(buffer).tobytes()):
                        n += len(words)
                        found.update(filter(vocabulary.__contains__, words))
                if n:
                    places.append(i)
                    sizes.append(n)
                    terms.extend(vocabulary[w] for w in found)
                    counts.extend(found.values())
                    ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(places, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))], ["doc_id", "n", "terms", "counts"])
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(rows, COUNTED.format(id=id_type))


def _exact(a: np.ndarray, reach: int) -> np.ndarray:
    """Longs where ``reach`` fits them, else Python's integers."""
    return a.astype(np.int64 if reach < 1 << 63 else object)


def impacts(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, docs: int, length: int) -> np.ndarray:
    """w * ((10^9 tf) div (1000 tf + 8 m)) with m = 10 + (90 n N) div L."""
    m = 10 + _exact(n, 90 * docs * int(n.max(initial=0))) * 90 * docs // length
    m = m.astype(np.int64)
    tf = _exact(tf, 10 ** 9 * int(tf.max(initial=0)))
    return (weight * ((10 ** 9 * tf) // (1000 * tf + 8 * m))).astype(np.int64)


class Block:
    """Documents of a block by length, their postings by term, and the sparse table of impacts."""

    def __init__(self, ids: list, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray,
                 weights: np.ndarray, docs: int, length: int):
        order = np.argsort(n, kind="stable")
        self.ids = [ids[i] for i in order.tolist()]
        place = np.empty(len(n), np.int64)
        place[order] = np.arange(len(n))
        self.size = len(n)
        # a posting's key: its term, then its document's place
        key = term.astype(np.int64) * self.size + place[doc]
        by = np.argsort(key)
        self.key = key[by]
        self.doc = self.key % self.size
        self.impact = impacts(tf[by], n[doc][by], weights[term[by]], docs, length)
        # row k, entry i: the place of the largest of 2^k impacts from i on
        self.table = [np.arange(len(by), dtype=np.int32)]
        longest = int(np.diff(np.flatnonzero(np.diff(self.key // self.size, prepend=-1, append=-1))).max(initial=1))
        while (span := 1 << len(self.table)) <= longest:
            half, last = span >> 1, self.table[-1]
            a, b = last[:-half], last[half:]
            self.table.append(np.where(self.impact[a] >= self.impact[b], a, b))

    def maxima(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Places of the largest impact in each of the ranges lo..hi, none empty."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level).tolist():
            rows = np.flatnonzero(level == k)
            a, b = self.table[k][lo[rows]], self.table[k][hi[rows] - (1 << k)]
            out[rows] = np.where(self.impact[a] >= self.impact[b], a, b)
        return out

    def search(self, terms: np.ndarray, best: list, top: int, cell: int) -> int:
        """Put the best documents for an item into ``best``, a heap of (score, order); gives the cells scored."""
        base = terms.astype(np.int64) * self.size
        waiting: list = []

        def push(first: int, last: int, own: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
            some = hi > lo
            if first < last and some.any():
                lo, hi = lo[some], hi[some]
                at = self.maxima(lo, hi)
                top_impact = self.impact[at]
                bound = int(top_impact.sum())
                if bound and not (len(best) == top and bound < best[0][0]):
                    peak = int(self.doc[at[top_impact.argmax()]])
                    heapq.heappush(waiting, (-bound, first, last, peak, own[some], lo, hi))
        push(0, self.size, base, np.searchsorted(self.key, base), np.searchsorted(self.key, base + self.size))
        cells = 0
        while waiting:
            bound, first, last, peak, own, lo, hi = heapq.heappop(waiting)
            if len(best) == top and -bound < best[0][0]:
                break
            left = max(first, peak // cell * cell)
            right = min(last, left - left % cell + cell)
            a, b = np.searchsorted(self.key, own + left), np.searchsorted(self.key, own + right)
            self._score(a, b, left, right, best, top)
            cells += 1
            push(first, left, own, lo, a)
            push(right, last, own, b, hi)
        return cells

    def _score(self, a: np.ndarray, b: np.ndarray, left: int, right: int, best: list, top: int) -> None:
        size = b - a
        postings = np.repeat(a - np.cumsum(size) + size, size) + np.arange(size.sum())
        scores = np.zeros(right - left, np.int64)
        np.add.at(scores, self.doc[postings] - left, self.impact[postings])
        least = best[0][0] if len(best) == top else 1
        for i in np.flatnonzero(scores >= least).tolist():
            entry = (int(scores[i]), _Order(self.ids[left + i]))
            if len(best) < top:
                heapq.heappush(best, entry)
            elif best[0] < entry:
                heapq.heapreplace(best, entry)


class _Order:
    """Ids so that the greater one, and then any id after null, is the lesser."""

    __slots__ = ("id",)

    def __init__(self, id):
        self.id = id

    def __lt__(self, other: _Order) -> bool:
        if self.id is None or other.id is None:
            return self.id is not None and other.id is None
        return self.id > other.id

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Order) and self.id == other.id


def _blocks(batches: Iterator[pa.RecordBatch], most_postings: int, most_docs: int):
    """(ids, n, doc, term, tf) of blocks; one document may exceed the postings by itself."""
    ids, n, doc, term, tf, held = [], [], [], [], [], 0

    def joined():
        return ids, np.concatenate(n), np.concatenate(doc), np.concatenate(term), np.concatenate(tf)
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            size = np.asarray(batch["terms"].value_lengths().to_numpy(zero_copy_only=False), np.int64)
            doc.append(np.repeat(np.arange(len(size)) + len(ids), size))
            ids.extend(batch["doc_id"].to_pylist())
            n.append(batch["n"].to_numpy())
            term.append(batch["terms"].flatten().to_numpy())
            tf.append(batch["counts"].flatten().to_numpy())
            held += int(size.sum())
            if held >= most_postings or len(ids) >= most_docs:
                yield joined()
                ids, n, doc, term, tf, held = [], [], [], [], [], 0
    if ids:
        yield joined()


def rank_block(docs: DataFrame, item_terms: DataFrame, top: int = TOP, cell: int = CELL,
               most_postings: int = BLOCK_POSTINGS, most_docs: int = BLOCK_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score) for the items of one block; ``item_terms`` (item_id, term) fits the driver."""
    items: dict = {}
    vocabulary: dict[bytes, int] = {}
    for r in item_terms.collect():
        items.setdefault(r.item_id, set()).add(vocabulary.setdefault(bytes(r.term), len(vocabulary)))
    counted = materialize(count_terms(docs, vocabulary), "postings")
    total = counted.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    n_docs, length = total.docs, total.length or 1
    weights = np.zeros(len(vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        weights[r.t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    asked = [(i, np.array(sorted(t for t in terms if weights[t] > 0), np.int32)) for i, terms in enumerate(items.values())]
    names = list(items)
    id_type, kind = docs.schema["doc_id"].dataType.simpleString(), to_arrow_type(docs.schema["doc_id"].dataType)
    item_type = item_terms.schema["item_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in asked]
        for batch_ids, n, doc, term, tf in _blocks(batches, most_postings, most_docs):
            block = Block(batch_ids, n, doc, term, tf, weights, n_docs, length)
            for i, terms in asked:
                block.search(terms, best[i], top, cell)
        out = [(i, o.id, s) for i, heap in enumerate(best) for s, o in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], kind),
             pa.array([x[2] for x in out], pa.int64())], ["item", "doc_id", "score"])
    found = counted.mapInArrow(rows, f"item int, doc_id {id_type}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    named = docs.sparkSession.createDataFrame(list(enumerate(names)), f"item int, item_id {item_type}")
    # the items of a block are few by ITEM_CHARS
    return ranked.join(F.broadcast(named), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _item_terms(items: DataFrame, chars: int) -> Iterator[DataFrame]:
    """(item_id, term) of the items, in blocks of about ``chars`` characters."""
    slim = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    total = slim.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // chars) or 1

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, terms = [], []
            for i, text in enumerate(batch["text"]):
                own = {t for words in terms_of(text.as_py()) for t in words}
                places.extend([i] * len(own))
                terms.extend(own)
            yield pa.RecordBatch.from_arrays([batch["item_id"].take(pa.array(places, pa.int64())),
                                              pa.array(terms, pa.binary())], ["item_id", "term"])
    id_type = items.schema["item_id"].dataType.simpleString()
    for b in range(blocks):
        own = slim if blocks == 1 else slim.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        yield own.select("item_id", F.col("text").cast("binary").alias("text")) \
            .mapInArrow(split, f"item_id {id_type}, term binary").distinct()


def search(docs: DataFrame, items: DataFrame, item_chars: int = ITEM_CHARS, **limits) -> DataFrame:
    """The highest-scoring documents of every item."""
    parts = [rank_block(docs, terms, **limits) for terms in _item_terms(items, item_chars)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents ranked for each benchmark item."""
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents),
sized AS (SELECT r, doc_id, len(ws) AS n, ws FROM docs WHERE len(ws) > 0),
totals AS (SELECT count(*) AS nd, sum(n) AS nl FROM sized),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_WORD}')) AS t FROM benchmark),
words AS (SELECT r, doc_id, n, unnest(ws) AS t FROM sized),
tfs AS (SELECT r, doc_id, n, t, count(*) AS tf FROM words WHERE t IN (SELECT t FROM asked) GROUP BY r, doc_id, n, t),
dfs AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * max(nd) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM tfs, totals GROUP BY t),
impacts AS (SELECT r, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // nl))) AS impact
            FROM tfs JOIN dfs USING (t), totals),
scores AS (SELECT a.item_id, i.r, i.doc_id, CAST(sum(i.impact) AS BIGINT) AS score
           FROM asked a JOIN impacts i ON i.t = a.t GROUP BY a.item_id, i.r, i.doc_id HAVING sum(i.impact) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores)
WHERE rank <= {TOP}"""
