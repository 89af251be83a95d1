"""Removal of repeated 200-byte strings by two-stage suffix sorting.

A byte goes if a ``WINDOW``-byte string that covers it also starts anywhere
else in any document.  Suffixes of the whole corpus cannot be shuffled, so
strings that can be equal are first brought together:

1. Every window has one anchor, the 64-byte gram in it with the least hash
   (the rightmost of equals).  The anchor depends on the window's bytes alone,
   so equal windows have equal anchors.  Neighbouring windows with the same
   anchor form one context; about one context per 70 bytes is shuffled, as
   hashes and positions, and contexts whose anchor occurs once fall out.
2. Equal contexts are counted with map-side sums.  A context that occurs twice
   is repeated as a whole.
3. The distinct contexts of an anchor that has several are laid side by side in
   blocks, and a block's suffix array is built in two stages: suffixes smaller
   than their successors are sorted directly (to the window's depth), all
   others are induced by one scan of the buckets.  Adjacent common prefixes of
   at least the window mark repeated windows.

An anchor with more than ``MAX_CONTEXTS`` distinct contexts is not put into
one task: its windows are counted one by one by their digest, which gives the
same answer for any number of them.

Defined cases: null and empty texts have no bytes; texts shorter than a window
keep all; repeated rows and equal texts lose every window; texts of any length
are worked on in slices of bounded size; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm.common import arrow_rows, materialize, read_table

WINDOW = 200
GRAM = 64
SLICE = 1 << 20
BLOCK = 1 << 20
MAX_CONTEXTS = 20_000
SEPARATOR = 0xFF  # no byte of UTF-8 text

_BASE = 6364136223846793005
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """Hashes of all grams of a byte array, from prefix sums modulo 2^64."""

    def __init__(self, size: int):
        with np.errstate(over="ignore"):
            self.up = self._powers(size, _BASE)
            self.down = self._powers(size, pow(_BASE, -1, 1 << 64))

    @staticmethod
    def _powers(size: int, base: int) -> np.ndarray:
        p = np.full(size, base, dtype="uint64")
        p[0] = 1
        return np.cumprod(p)

    def __call__(self, b: np.ndarray, k: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            sums = np.zeros(len(b) + 1, dtype="uint64")
            np.cumsum((b.astype("uint64") + np.uint64(1)) * self.up[:len(b)], out=sums[1:])
            h = (sums[k:] - sums[:-k]) * self.down[:len(b) - k + 1]
            h ^= h >> np.uint64(32)
            h *= _MIX
            h ^= h >> np.uint64(29)
            h *= _MIX
        return h


def window_anchors(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` grams the position of the least, the rightmost of equals.

    The low bits of a hash give way to the position counted from the right, so
    one sliding minimum (block prefixes and suffixes) finds both."""
    n, bits = len(h), max(1, int(len(h) - 1).bit_length())
    low = np.uint64((1 << bits) - 1)
    key = (h & ~low) | (low - np.arange(n, dtype="uint64"))
    padded = np.full(-(-n // width) * width, np.iinfo("uint64").max, dtype="uint64")
    padded[:n] = key
    rows = padded.reshape(-1, width)
    first = np.minimum.accumulate(rows, axis=1).ravel()
    last = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(last[:n - width + 1], first[width - 1:n])
    return (low - (least & low)).astype("int64")


def contexts_of(raw: bytes, starts: list[int], grams: Grams, window: int = WINDOW, gram: int = GRAM):
    """Runs of windows with one anchor: (text number, first window, windows, anchor hash).

    ``raw`` holds several texts; ``starts`` are their first bytes.  Hash bits
    that give way to positions are the same 24 in any slice."""
    b = np.frombuffer(raw, "u1")
    h = grams(b, gram) if len(b) >= gram else np.empty(0, "uint64")
    if len(h) < window - gram + 1:
        return [], [], [], []
    at = window_anchors(h & ~np.uint64((1 << 24) - 1), window - gram + 1)
    edges = np.array([*starts, len(b)], dtype="int64")
    first = np.arange(len(at))
    text = np.searchsorted(edges, first, side="right") - 1
    inside = first + window <= edges[text + 1]
    same = np.zeros(len(at), dtype=bool)
    same[1:] = (at[1:] == at[:-1]) & (text[1:] == text[:-1]) & inside[:-1]
    begin = np.flatnonzero(inside & ~same)
    stop = np.flatnonzero(inside & ~np.append(same[1:], False) | inside & ~np.append(inside[1:], False)) + 1
    return text[begin], begin, stop - begin, h[at[begin]]


ANCHORS = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("hash", pa.int64()), ("ctx", pa.int64()),
                     ("st", pa.int64()), ("n", pa.int32())])


def _anchors(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    grams = Grams(SLICE + 4 * window)
    for batch in batches:
        ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        held: list[tuple[int, int, bytes]] = []
        size = 0
        for row, text in enumerate(batch.column(2).to_pylist()):
            raw = text.encode("utf-8", "surrogatepass") if text else b""
            for at in range(0, max(0, len(raw) - window + 1), SLICE):
                part = raw[at:at + SLICE + window - 1]
                if held and size + len(part) > SLICE:
                    yield _contexts(held, ids, hashes, grams, window, gram)
                    held, size = [], 0
                held.append((row, at, part))
                size += len(part)
        if held:
            yield _contexts(held, ids, hashes, grams, window, gram)


def _contexts(held, ids, hashes, grams: Grams, window: int, gram: int) -> pa.RecordBatch:
    raw = b"".join(part for _, _, part in held)
    starts = np.cumsum([0, *(len(part) for _, _, part in held[:-1])])
    text, begin, n, anchor = contexts_of(raw, starts.tolist(), grams, window, gram)
    view, digest = memoryview(raw), xxhash.xxh3_64_intdigest
    ctx = np.fromiter((digest(view[a:a + k + window - 1]) for a, k in zip(list(begin), list(n))), "uint64", len(begin))
    rows = np.array([r for r, _, _ in held], dtype="int64")
    offset = np.array([at for _, at, _ in held], dtype="int64") - starts
    text = np.asarray(text, dtype="int64")
    owner = rows[text]
    doc = pa.array(ids, pa.int64()).take(pa.array(owner))
    th = pa.array(hashes, pa.int64()).take(pa.array(owner))
    return pa.RecordBatch.from_arrays(
        [doc, th, pa.array(np.asarray(anchor, "uint64").view("int64")), pa.array(ctx.view("int64")),
         pa.array(np.asarray(begin, "int64") + offset[text]), pa.array(np.asarray(n, "int32"))], schema=ANCHORS)


# ---------------------------------------------------------------- suffix array of a block

def smaller_than_successor(t: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than the one after it (the last is not)."""
    n = len(t)
    up = np.zeros(n, dtype=bool)
    up[:-1] = t[:-1] < t[1:]
    differs = np.ones(n, dtype=bool)
    differs[:-1] = t[:-1] != t[1:]
    end = np.where(differs, np.arange(n), n - 1)
    end = np.minimum.accumulate(end[::-1])[::-1]
    return up[end]


def words_at(t: np.ndarray, beyond: int) -> np.ndarray:
    """The 8 bytes from each position on, as a big-endian number (zeros past the end)."""
    padded = np.concatenate((t, np.zeros(beyond + 8, dtype="u1")))
    w = np.zeros(len(t) + beyond, dtype="uint64")
    for k in range(8):
        w = (w << np.uint64(8)) | padded[k:k + len(w)]
    return w


def sort_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffix positions ordered by their first ``depth`` bytes, eight at a time;
    each round sorts only those that still tie."""
    order = np.argsort(words[at], kind="stable")
    at = at[order]
    key = words[at]
    group = np.cumsum(np.concatenate(([0], key[1:] != key[:-1]))) if len(at) else np.empty(0, "int64")
    tied = _tied(group)
    for k in range(8, depth, 8):
        if not len(tied):
            break
        key, own = words[at[tied] + k], group[tied]
        order = np.lexsort((key, own))
        at[tied] = at[tied][order]
        key, own = key[order], own[order]
        step = np.concatenate(([0], (key[1:] != key[:-1]) & (own[1:] == own[:-1])))
        # new groups start inside an old one: number them by their first place
        fresh = np.where(np.concatenate(([True], (own[1:] != own[:-1]) | (step[1:] == 1))), tied, 0)
        group[tied] = np.maximum.accumulate(fresh)
        tied = tied[_tied(group[tied])]
    return at


def _tied(group: np.ndarray) -> np.ndarray:
    """Places whose group has another member (equal groups are adjacent)."""
    if len(group) < 2:
        return np.empty(0, dtype="int64")
    same = group[1:] == group[:-1]
    return np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))


def suffix_array(t: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """Suffix array by two-stage sorting, right to ``depth`` bytes.

    Within a bucket (a first byte) the suffixes greater than their successors
    come first.  One scan over the buckets fills them: whatever stands at place
    i puts its predecessor, if greater, at the next free place of its bucket."""
    if words is None:
        words = words_at(t, depth + 8)
    smaller = smaller_than_successor(t)
    direct = sort_directly(np.flatnonzero(smaller), words, depth)
    cut = np.searchsorted(t[direct], np.arange(257))
    greater: list[list[np.ndarray]] = [[] for _ in range(256)]
    greater[t[-1]].append(np.array([len(t) - 1]))
    out = []
    for c in range(256):
        front = np.concatenate(greater[c]) if greater[c] else np.empty(0, dtype="int64")
        own = [front]
        while len(front):
            front = front[front > 0] - 1
            front = front[(t[front] == c) & ~smaller[front]]
            own.append(front)
        bucket = np.concatenate([*own, direct[cut[c]:cut[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[t[before] > c]
        first = t[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        edge = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1]))) if len(first) else []
        for a, b in zip(edge, [*edge[1:], len(first)]):
            greater[first[a]].append(before[a:b])
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, up to ``depth``."""
    length = np.zeros(len(order), dtype="int64")
    left = np.arange(1, len(order))
    for k in range(0, depth, 8):
        x = words[order[left] + k] ^ words[order[left - 1] + k]
        equal = x == 0
        done = left[~equal]
        lead = (63 - np.floor(np.log2(x[~equal].astype("float64"))).astype("int64").clip(0, 63)) // 8
        length[done] = np.minimum(depth, k + lead)
        left = left[equal]
        if not len(left):
            return length
    length[left] = depth
    return length


def repeated_windows(contexts: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each context, which of its windows occur elsewhere among the contexts."""
    t = np.frombuffer(b"\xff".join(contexts) + b"\xff", "u1")
    sizes = np.array([len(c) for c in contexts], dtype="int64")
    starts = np.cumsum(np.concatenate(([0], sizes[:-1] + 1)))
    whole = np.zeros(len(t) + 1, dtype="int64")
    np.add.at(whole, starts, 1)
    np.add.at(whole, starts + np.maximum(0, sizes - window + 1), -1)
    is_window = np.cumsum(whole[:-1]) > 0
    words = words_at(t, window + 8)
    order = suffix_array(t, window, words)
    order = order[is_window[order]]
    prefix = common_prefixes(order, words, window)
    twin = prefix >= window
    found = np.zeros(len(t), dtype=bool)
    found[order[twin]] = True
    found[order[np.flatnonzero(twin) - 1]] = True
    return [found[a:a + max(0, s - window + 1)] for a, s in zip(starts, sizes)]


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype("int8")))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


# ---------------------------------------------------------------- Spark jobs

SPANS = pa.schema([("hash", pa.int64()), ("ctx", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])


def _blocks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Suffix-sort a sorted stream of (hash, ctx, bytes) in blocks of whole anchors."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for batch in batches:
        for h, ctx, raw in zip(*(c.to_pylist() for c in batch.columns)):
            if size >= BLOCK and h != held[-1][0]:
                yield _repeated(held, window)
                held, size = [], 0
            held.append((h, ctx, raw))
            size += len(raw)
    if held:
        yield _repeated(held, window)


def _repeated(held, window: int) -> pa.RecordBatch:
    out: dict[str, list] = {f.name: [] for f in SPANS}
    for (h, ctx, _), mask in zip(held, repeated_windows([raw for _, _, raw in held], window)):
        for a, b in runs(mask):
            out["hash"].append(h)
            out["ctx"].append(ctx)
            out["a"].append(a)
            out["b"].append(b)
    return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in SPANS], schema=SPANS)


def _slice_contexts(window: int):
    schema = pa.schema([("hash", pa.int64()), ("ctx", pa.int64()), ("raw", pa.binary())])

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"hash": [], "ctx": [], "raw": []}
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                for w in wanted:
                    out["hash"].append(w["hash"])
                    out["ctx"].append(w["ctx"])
                    out["raw"].append(raw[w["st"]:w["st"] + w["n"] + window - 1])
            return out
        return work
    return arrow_rows(make, schema, 512)


def _window_digests(window: int):
    schema = pa.schema([("hash", pa.int64()), ("ctx", pa.int64()), ("a", pa.int32()), ("w1", pa.int64()),
                        ("w2", pa.int64())])

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {f.name: [] for f in schema}
            for h, ctx, raw in zip(*(c.to_pylist() for c in batch.columns)):
                view = memoryview(raw)
                for a in range(len(raw) - window + 1):
                    d = xxhash.xxh3_128_digest(view[a:a + window])
                    out["hash"].append(h)
                    out["ctx"].append(ctx)
                    out["a"].append(a)
                    out["w1"].append(int.from_bytes(d[:8], "big", signed=True))
                    out["w2"].append(int.from_bytes(d[8:], "big", signed=True))
            return out
        return work
    return arrow_rows(make, schema, 256)


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                   max_contexts: int = MAX_CONTEXTS) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): the texts that hold repeated strings, by (doc_id, th), and
    the byte spans to remove in them (a, b), overlapping ones not yet merged.

    ``docs`` has doc_id, text and th, a 64-bit hash of the text; rows that agree
    in both have the same text."""
    anchors = materialize(docs.select("doc_id", "th", "text").where(F.octet_length("text") >= window).mapInArrow(
        lambda b: _anchors(b, window, gram), "doc_id long, th long, hash long, ctx long, st long, n int"), "anchors")
    twice = anchors.groupBy("hash").agg(F.count("*").alias("uses"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi")) \
        .where("uses > 1").select("hash", (F.col("lo") != F.col("hi")).alias("several"))
    near = materialize(anchors.join(twice, "hash"), "near")
    # one row per distinct context: how often it occurs, and one place where it does
    ctx = materialize(near.groupBy("hash", "ctx").agg(F.count("*").alias("uses"), F.first("several").alias("several"),
                                                      F.min(F.struct("doc_id", "th", "st", "n")).alias("at")), "ctx")
    keys = ctx.select("at.doc_id", "at.th").union(
        near.join(ctx.where("uses > 1").select("hash", "ctx"), ["hash", "ctx"], "left_semi").select("doc_id", "th"))
    wanted_docs = keys.distinct().select(F.col("doc_id").alias("k1"), F.col("th").alias("k2"))
    texts = materialize(docs.join(wanted_docs, docs["doc_id"].eqNullSafe(F.col("k1"))
                                  & docs["th"].eqNullSafe(F.col("k2")), "left_semi")
                        .groupBy("doc_id", "th").agg(F.min("text").alias("text")), "texts")
    spans = _places(near, ctx, _found(ctx, texts, window, max_contexts), window)
    return texts, spans


def _found(ctx: DataFrame, texts: DataFrame, window: int, max_contexts: int) -> DataFrame:
    """Repeated runs of windows (hash, ctx, a, b) inside contexts that occur once."""
    several = ctx.where("several").select("hash", "ctx", "uses", "at")
    sizes = several.groupBy("hash").agg(F.count("*").alias("contexts"))
    need = several.groupBy(F.col("at.doc_id").alias("k1"), F.col("at.th").alias("k2")) \
        .agg(F.collect_list(F.struct("hash", "ctx", "at.st", "at.n")).alias("wanted"))
    raw = texts.join(need, texts["doc_id"].eqNullSafe(F.col("k1")) & texts["th"].eqNullSafe(F.col("k2"))) \
        .select("text", "wanted").mapInArrow(_slice_contexts(window), "hash long, ctx long, raw binary")
    sized = materialize(raw.join(sizes, "hash"), "contexts")
    sorted_rows = sized.where(F.col("contexts") <= max_contexts).select("hash", "ctx", "raw") \
        .repartition("hash").sortWithinPartitions("hash")
    by_array = sorted_rows.mapInArrow(lambda b: _blocks(b, window), "hash long, ctx long, a int, b int")
    single = sized.where(F.col("contexts") > max_contexts).select("hash", "ctx", "raw") \
        .mapInArrow(_window_digests(window), "hash long, ctx long, a int, w1 long, w2 long")
    more = single.groupBy("w1", "w2").agg(F.count("*").alias("uses")).where("uses > 1").drop("uses")
    by_count = single.join(more, ["w1", "w2"]).select("hash", "ctx", "a", (F.col("a") + 1).alias("b"))
    once = ctx.where("uses = 1").select("hash", "ctx")
    return by_array.unionByName(by_count).join(once, ["hash", "ctx"], "left_semi")


def _places(near: DataFrame, ctx: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """Byte spans (doc_id, th, a, b) of every occurrence of repeated windows."""
    whole = near.join(ctx.where("uses > 1").select("hash", "ctx"), ["hash", "ctx"], "left_semi") \
        .select("doc_id", "th", F.col("st").alias("a"), (F.col("st") + F.col("n")).alias("b"))
    at = ctx.select("hash", "ctx", "at.doc_id", "at.th", "at.st")
    part = found.join(at, ["hash", "ctx"]).select("doc_id", "th", (F.col("st") + F.col("a")).alias("a"),
                                                  (F.col("st") + F.col("b")).alias("b"))
    return whole.unionByName(part).distinct().withColumn("b", F.col("b") + window - 1)


CUT = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                 ("kept_sha256", pa.string()), ("kept", pa.binary())])


def merge_spans(spans) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _cut():
    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {f.name: [] for f in CUT}
        for doc, th, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            raw = text.encode("utf-8", "surrogatepass")
            merged = merge_spans((s["a"], s["b"]) for s in spans)
            kept, last = [], 0
            for a, b in merged:
                kept.append(raw[last:a])
                last = b
            kept.append(raw[last:])
            left = b"".join(kept)
            for name, value in zip(out, (doc, th, sum(b - a for a, b in merged), len(merged),
                                         hashlib.sha256(left).hexdigest(), left)):
                out[name].append(value)
        return out
    return work


def cut_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, th, n_removed, n_spans, kept_sha256, kept) of the texts that lose bytes;
    ``kept`` holds the remaining bytes."""
    texts, spans = repeated_spans(docs, window)
    per_text = spans.groupBy(F.col("doc_id").alias("k1"), F.col("th").alias("k2")) \
        .agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    joined = texts.join(per_text, texts["doc_id"].eqNullSafe(F.col("k1")) & texts["th"].eqNullSafe(F.col("k2"))) \
        .select("doc_id", "th", "text", "spans")
    return joined.mapInArrow(arrow_rows(_cut, CUT, 512), "doc_id long, th long, n_removed long, n_spans long, "
                             "kept_sha256 string, kept binary")


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs and the digest of what is left."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .withColumn("th", F.xxhash64("text"))
    cut = materialize(cut_repeats(slim, window).drop("kept"), "cut") \
        .select(F.col("doc_id").alias("k1"), F.col("th").alias("k2"), "n_removed", "n_spans", "kept_sha256")
    base = slim.select("doc_id", "th", F.octet_length("text").cast("long").alias("n_bytes"),
                       F.sha2("text", 256).alias("sha"))
    joined = base.join(cut, base["doc_id"].eqNullSafe(F.col("k1")) & (base["th"] == F.col("k2")), "left")
    return joined.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                         F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
                         F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated 200-byte strings."""
    return report(read_table(spark, sf_dir, "documents"))
