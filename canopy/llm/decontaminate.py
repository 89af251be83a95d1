"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all benchmark items (or of one block of them, when
they exceed ``block_words``) become one suffix automaton.  Each document's
words are streamed through it; the automaton gives, at every word, the longest
run ending there that occurs in some item.  A run of ``window`` words or more
is contaminated, and so is a whole item of fewer words.

Only the benchmark block is broadcast and its size is checked against
``block_words`` first; a larger benchmark is scanned block by block and the
blocks' hits are merged by the text's digest.

Defined cases: null and empty texts have no words and no hits; an item without
words has no window; repeated items count once per distinct id; items without
an id hit words too, count as one item together and are left out of the digest;
repeated documents give a row each; an empty table on either side gives zero hits or
zero rows; other columns are ignored by the report and kept by
``remove_spans``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm.common import arrow_rows, materialize, read_table

WINDOW = 10
BLOCK_WORDS = 1_000_000
MAX_COVERAGE = 0.5

#: Lower-cases A-Z and turns every byte that is not part of a word into a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
             for b in range(256))
_WORD = re.compile(rb"[^\x20]+")

REPORT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                    ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])
HITS = pa.schema([("digest", pa.string()),
                  ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                  ("items", pa.list_(pa.string()))])


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton over word ids, with the items of each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: dict[int, set[str]] = {}
        for item, words in items:
            last = 0
            for w in words:
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)))
                ends.setdefault(last, set()).add(item)
        self.least = min([window, *(len(w) for _, w in items if w)])
        self._mark(items, ends)
        self._bigrams(items)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(length)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        new = len(length)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = new
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def _mark(self, items, ends) -> None:
        """``owners[v]``: the items with a full window whose last ``window`` words
        are those of state v; ``whole[v]``: (length, items) of short items that
        are suffixes of v's strings."""
        order = sorted(range(len(self.len)), key=self.len.__getitem__)
        self.owners: dict[int, set[str]] = {}
        anchor: list[int] = [-1] * len(order)
        for v in order:
            up = self.link[v]
            if self.len[v] >= self.window:
                anchor[v] = v if up < 0 or self.len[up] < self.window else anchor[up]
        for v in order:
            if v in ends and anchor[v] >= 0:
                self.owners.setdefault(anchor[v], set()).update(ends[v])
        self.anchor = anchor
        short: dict[int, dict[int, set[str]]] = {}
        for item, words in items:
            if 0 < len(words) < self.window:
                v = 0
                for w in words:
                    v = self.next[v][self.vocab[w]]
                short.setdefault(v, {}).setdefault(len(words), set()).add(item)
        self.whole: list[list[tuple[int, set[str]]]] = [[] for _ in order]
        if short:
            for v in order[1:]:
                self.whole[v] = self.whole[self.link[v]] + sorted(
                    ((n, s) for n, s in short.get(v, {}).items()), key=lambda x: x[0])

    def _bigrams(self, items) -> None:
        """Sorted keys of the word pairs that stand side by side in an item."""
        base = len(self.vocab) + 1
        pairs = {self.vocab[a] * base + self.vocab[b] for _, ws in items for a, b in zip(ws, ws[1:])}
        self.pairs = np.array(sorted(pairs), dtype="int64")
        self.base = base

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(merged half-open word spans that are hit, items with occurring windows)."""
        ids = list(map(self.vocab.get, words))
        spans: list[tuple[int, int]] = []
        items: set[str | None] = set()
        for a, b in self._runs(ids):
            self._match(ids, a, b, spans, items)
        spans.sort()
        merged: list[tuple[int, int]] = []
        for a, b in spans:
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged, items

    def _runs(self, ids: list) -> list[tuple[int, int]]:
        """Stretches in which a window can lie: all neighbouring pairs occur in items."""
        if len(ids) < self.least or not self.vocab:
            return []
        known = np.array([-1 if x is None else x for x in ids], dtype="int64")
        if self.least == 1:
            joined = np.ones(len(ids) - 1, dtype=bool)
        else:
            key = known[:-1] * self.base + known[1:]
            at = np.searchsorted(self.pairs, key)
            at[at == len(self.pairs)] = 0
            joined = (self.pairs[at] == key) & (known[:-1] >= 0) & (known[1:] >= 0)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], joined, [False])).astype("int8")))
        runs = [(int(a), int(b) + 1) for a, b in zip(edge[::2], edge[1::2]) if b + 1 - a >= self.least]
        return runs if len(ids) > 1 else [(0, 1)]

    def _match(self, ids, a: int, b: int, spans, items) -> None:
        state, length, window = 0, 0, self.window
        nxt, link, lens, whole = self.next, self.link, self.len, self.whole
        for i in range(a, b):
            c = ids[i]
            if c is None:
                state = length = 0
                continue
            while state and c not in nxt[state]:
                state = link[state]
                length = lens[state]
            if c in nxt[state]:
                state = nxt[state][c]
                length += 1
            if length >= window:
                spans.append((i + 1 - length, i + 1))
                items |= self.owners.get(self.anchor[state], set())
            if whole[state]:
                for n, owners in whole[state]:
                    if n <= length:
                        spans.append((i + 1 - n, i + 1))
                        items |= owners


def item_blocks(bench: DataFrame, id_col: str, text_col: str, block_words: int):
    """Lists of (item id as text, words), each of about ``block_words`` words; items
    longer than a block make a block of their own."""
    items = bench.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("t")) \
        .where(F.col("t").isNotNull()).distinct()
    letters = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-letters // (6 * block_words)))
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == b)
        yield [(r["id"], words_of(r["t"])) for r in part.toLocalIterator()], blocks


def _automaton(shared, window: int):
    """One automaton per Python worker and broadcast."""
    cache = _automaton.__dict__.setdefault("kept", {})
    if shared.value[0] not in cache:
        cache.clear()
        cache[shared.value[0]] = SuffixAutomaton(shared.value[1], window)
    return cache[shared.value[0]]


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(i for i in items if i is not None)).encode()).hexdigest()


def report(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
           doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """Per document: words, hit words, items with occurring windows and their digest."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    hits = scan_blocks(slim, bench, window, block_words, item_id, item_text)
    if isinstance(hits, DataFrame):
        return _report_merged(slim, hits)
    shared = hits

    def make():
        auto = _automaton(shared, window)

        def work(batch: pa.RecordBatch) -> dict:
            n_words, n_hit, n_items, digest = [], [], [], []
            for t in batch.column(1).to_pylist():
                words = words_of(t)
                spans, items = auto.scan(words)
                n_words.append(len(words))
                n_hit.append(sum(b - a for a, b in spans))
                n_items.append(len(items))
                digest.append(_digest(items))
            return {"doc_id": batch.column(0), "n_words": n_words, "n_hit": n_hit, "n_items": n_items,
                    "items_sha256": digest, "contaminated": [x > 0 for x in n_hit]}
        return work
    return slim.mapInArrow(arrow_rows(make, REPORT), "doc_id long, n_words long, n_hit long, n_items long, "
                           "items_sha256 string, contaminated boolean")


def scan_blocks(slim: DataFrame, bench: DataFrame, window: int, block_words: int, item_id: str, item_text: str):
    """A broadcast of the items if one block holds them, else the merged hits of all
    blocks by text digest: (digest, spans, items)."""
    sc = slim.sparkSession.sparkContext
    found = []
    for number, (items, blocks) in enumerate(item_blocks(bench, item_id, item_text, block_words)):
        shared = sc.broadcast((f"{sc.applicationId}-{id(slim)}-{number}-{window}-{hash(tuple(i for i, _ in items))}",
                               items))
        if blocks == 1:
            return shared
        texts = slim.select(F.sha2("text", 256).alias("digest"), "text").where(F.col("text").isNotNull())
        found.append(materialize(texts.mapInArrow(_hits(shared, window), "digest string, spans array<struct<a:long,"
                                                  "b:long>>, items array<string>").dropDuplicates(["digest"]),
                                 "hits"))
        shared.unpersist()
    merged = found[0]
    for more in found[1:]:
        merged = merged.unionByName(more)
    return merged.groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def _hits(shared, window: int):
    def make():
        auto = _automaton(shared, window)

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"digest": [], "spans": [], "items": []}
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans, items = auto.scan(words_of(t))
                if spans:
                    out["digest"].append(key)
                    out["spans"].append([{"a": a, "b": b} for a, b in spans])
                    out["items"].append(list(items))
            return out
        return work
    return arrow_rows(make, HITS)


def _union(spans) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _report_merged(slim: DataFrame, hits: DataFrame) -> DataFrame:
    joined = slim.withColumn("digest", F.sha2("text", 256)).join(hits, "digest", "left") \
        .select("doc_id", "text", "spans", "items")

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            spans = [_union(s) for s in batch.column(2).to_pylist()]
            items = [i or [] for i in batch.column(3).to_pylist()]
            n_hit = [sum(b - a for a, b in s) for s in spans]
            return {"doc_id": batch.column(0), "n_words": [len(words_of(t)) for t in batch.column(1).to_pylist()],
                    "n_hit": n_hit, "n_items": [len(i) for i in items],
                    "items_sha256": [_digest(i) for i in items], "contaminated": [x > 0 for x in n_hit]}
        return work
    return joined.mapInArrow(arrow_rows(make, REPORT), "doc_id long, n_words long, n_hit long, n_items long, "
                             "items_sha256 string, contaminated boolean")


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the characters from the first to the last word of each span."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(raw.translate(FOLD))]
    kept, last = [], 0
    for a, b in spans:
        kept.append(raw[last:at[a][0]])
        last = at[b - 1][1]
    kept.append(raw[last:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def remove_spans(docs: DataFrame, bench: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
                 block_words: int = BLOCK_WORDS, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """Documents with contaminated spans cut out of ``text``; a document of whose
    words more than ``max_coverage`` are hit goes as a whole.  Clean documents
    keep their text byte for byte, and every column keeps its name."""
    slim = docs.select(F.col(text).alias("text"))
    hits = scan_blocks(slim, bench, window, block_words, item_id, item_text)
    cleaned, gone = "__clean_text", "__covered"
    if isinstance(hits, DataFrame):
        keyed = docs.withColumn("__digest", F.sha2(F.col(text), 256))
        marked = keyed.join(hits.select(F.col("digest").alias("__digest"), F.col("spans").alias("__spans")),
                            "__digest", "left").drop("__digest")

        @F.pandas_udf(f"{cleaned} string, {gone} double")
        def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([_cut_row(t, _union(s)) for t, s in zip(texts, spans)], columns=[cleaned, gone])
        result = marked.withColumn("__cut", cut(F.col(text), F.col("__spans"))).drop("__spans")
    else:
        shared = hits

        @F.pandas_udf(f"{cleaned} string, {gone} double")
        def cut(texts: pd.Series) -> pd.DataFrame:
            auto = _automaton(shared, window)
            return pd.DataFrame([_cut_row(t, auto.scan(words_of(t))[0]) for t in texts], columns=[cleaned, gone])
        result = docs.withColumn("__cut", cut(F.col(text)))
    kept = result.where(F.col(f"__cut.{gone}") <= max_coverage)
    return kept.withColumn(text, F.col(f"__cut.{cleaned}")).select(*docs.columns)


def _cut_row(text: str | None, spans) -> tuple[str | None, float]:
    if not spans or text is None:
        return text, 0.0
    return cut_text(text, spans), sum(b - a for a, b in spans) / len(words_of(text))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, 10-word windows."""
    return report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
pos AS (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS at FROM (SELECT DISTINCT doc_id, p, n FROM hit)),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id),
hits AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.joined, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits h USING (doc_id) LEFT JOIN items t USING (doc_id)
"""
