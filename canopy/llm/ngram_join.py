"""N-gram Jaccard join with grouped prefixes, and its connected components.

A document's set is its distinct word shingles as 64-bit hashes.  Documents
with equal sets are one class.  Shingles are ordered by a frequency sketch
over all documents (2^22 counters, whatever the input) and then by hash; two
sets can only be similar enough if they share a shingle in their first
``n - ceil(t n) + 1``.  Classes with the same size and the same such prefix
are one group, and only groups enter the prefix join.

What is asked for are the components, so no bucket of a shingle is paired in
full.  First every group of a bucket is tried against the bucket's smallest
group alone (as many pairs as rows).  Found links give first components, and
only buckets that still hold several of them are looked at again, in tiles of
bounded size, where size, position and a parity sketch of the sets bound the
overlap from above.  One round tries the closest pairs that would join the
components of a tile into a forest, so a group of copies costs pairs in
proportion to its members; a last round tries every pair across components
that is left.  All pairs are verified on the full sets, and no link between
different texts is lost: two linked sets share a bucket, and are either in one
component already or meet in a tile of the last round.

Defined cases: null and empty texts (and texts of separators only) have an
empty set and are linked with nothing; fewer words than a shingle make one
shingle of all; equal texts and repeated rows are in one class; repeated ids
give a row each; a null id is its own smallest id; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from canopy.llm.common import arrow_rows, materialize, read_table
from canopy.operators.components import connected_components
from canopy.operators.util import discard

SHINGLE = 4
PERCENT = 85
SKETCH_BITS = 22
TILE = 2048
CACHE_ENTRIES = 300_000
MAX_PARITY_BITS = 1 << 14
FOREST_ROUNDS = 1
SMALL_BUCKET = 32
BROADCAST_PAIRS = 200_000

#: Lower-cases A-Z and leaves the rest; words are split at space and \t-\r.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingler(dict):
    """Text -> sorted distinct shingle hashes; remembers the hashes of words."""

    def __init__(self, size: int = SHINGLE):
        super().__init__()
        self.size = size

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 32:
            self[word] = h
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []
        if not words:
            return np.empty(0, "uint64")
        h = np.fromiter(map(self.__getitem__, words), "uint64", len(words))
        size = min(self.size, len(words))
        with np.errstate(over="ignore"):
            out = h[:len(h) - size + 1].copy()
            for k in range(1, size):
                out = (out ^ (out >> np.uint64(29))) * _MIX + h[k:len(h) - size + 1 + k]
            out ^= out >> np.uint64(32)
            out *= _MIX
            out ^= out >> np.uint64(29)
        return np.unique(out)


def least_overlap(n, percent: int = PERCENT):
    """Shingles that a set of n must share with any similar set."""
    return -(-percent * n // 100)


def class_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def parity(shingles: np.ndarray) -> bytes:
    """Parity sketch: each shingle flips a bit; equal shingles of two sets cancel."""
    bits = 64
    while bits < min(2 * len(shingles), MAX_PARITY_BITS):
        bits *= 2
    odd = np.bincount((shingles >> np.uint64(7)).astype("int64") & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype("uint8"), bitorder="little").tobytes()


# ---------------------------------------------------------------- classes and frequencies

def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0: (id, text hash, n, class key); of kind 1: slices of the task's sketch."""
    shingler = Shingler(size)
    sketch = np.zeros(1 << SKETCH_BITS, dtype="uint32")
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            sets = [shingler(t) for t in part.column(2).to_pylist()]
            slots = np.concatenate([s >> np.uint64(64 - SKETCH_BITS) for s in sets]).astype("int64")
            np.add.at(sketch, slots, 1)
            yield _tagged(part.column(0), part.column(1), [len(s) for s in sets],
                          [class_key(s) if len(s) else None for s in sets], 0)
    slices = [x.tobytes() for x in sketch.reshape(256, -1)]
    none = pa.nulls(256, pa.int64())
    yield _tagged(none, none, list(range(256)), slices, 1)


def _tagged(ids, hashes, n, data, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(n), pa.int32()), ids, hashes, pa.array(n, pa.int64()),
                                       pa.array(data, pa.binary())], ["kind", "doc_id", "th", "n", "data"])


def _level(counts: np.ndarray) -> np.ndarray:
    """Counts on a log scale of 256 steps."""
    return np.minimum(255, np.round(8 * np.log2(counts.astype("float64") + 1))).astype("uint8")


def _sum_slices(part: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, "uint32").astype("uint64") for x in part["data"])
    return pd.DataFrame({"n": part["n"].iloc[:1], "data": [_level(total).tobytes()]})


# ---------------------------------------------------------------- prefixes

def ordered_prefix(shingles: np.ndarray, levels: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first ``n - ceil(t n) + 1`` shingles, the rarest first."""
    n = len(shingles)
    take = n - least_overlap(n, percent) + 1
    order = np.lexsort((shingles, levels[(shingles >> np.uint64(64 - SKETCH_BITS)).astype("int64")]))
    return shingles[order[:take]]


PREFIX = pa.schema([("key", pa.binary()), ("gid", pa.binary()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64()))])


def _prefixes(shared, size: int, percent: int):
    def make():
        shingler, levels = Shingler(size), np.frombuffer(shared.value, "uint8")

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {f.name: [] for f in PREFIX}
            for t in batch.column(0).to_pylist():
                s = shingler(t)
                if len(s):
                    p = ordered_prefix(s, levels, percent)
                    out["key"].append(class_key(s))
                    out["gid"].append(hashlib.blake2b(p.tobytes(), digest_size=16, key=str(len(s)).encode()).digest())
                    out["n"].append(len(s))
                    out["prefix"].append(p.view("int64"))
            return out
        return work
    return arrow_rows(make, PREFIX)


# ---------------------------------------------------------------- verification

def _verify(size: int, percent: int):
    def make():
        shingler = Shingler(size)

        def work(batch: pa.RecordBatch) -> dict:
            a, b, last, x = [], [], None, None
            for ka, kb, ta, tb in zip(*(c.to_pylist() for c in batch.columns)):
                if ka != last:
                    last, x = ka, shingler(ta)
                y = shingler(tb)
                if similar(x, y, percent):
                    a.append(ka)
                    b.append(kb)
            return {"src": a, "dst": b}
        return work
    return arrow_rows(make, pa.schema([("src", pa.binary()), ("dst", pa.binary())]))


def similar(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """100 * intersection >= percent * union, of sorted distinct arrays."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large) or not len(small):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int(np.count_nonzero(large[at] == small))
    return 100 * common >= percent * (len(x) + len(y) - common)


# ---------------------------------------------------------------- tiles

TILED = pa.schema([("src", pa.binary()), ("dst", pa.binary())])


def fold_parity(sketches: list[bytes], bits: int) -> np.ndarray:
    """Parity sketches folded to ``bits`` bits each, as rows of 64-bit words."""
    out = np.zeros((len(sketches), bits // 64), dtype="uint64")
    for k, s in enumerate(sketches):
        words = np.frombuffer(s, "<u8")
        out[k] = np.bitwise_xor.reduce(words.reshape(-1, bits // 64), axis=0)
    return out


def tile_pairs(left: pd.DataFrame, right: pd.DataFrame, same: bool, percent: int):
    """Places (i, j) and sketch distance of the pairs that may be similar and lie in
    different components."""
    n1, n2 = left["n"].to_numpy()[:, None], right["n"].to_numpy()[None, :]
    need = -(-percent * (n1 + n2) // (100 + percent))
    room = np.minimum(n1 - left["pos"].to_numpy()[:, None], n2 - right["pos"].to_numpy()[None, :])
    may = (room >= need) & (left["comp"].to_numpy()[:, None] != right["comp"].to_numpy()[None, :])
    if same:
        may &= np.triu(np.ones(may.shape, dtype=bool), 1)
    i, j = np.nonzero(may)
    if not len(i):
        return i, j, i
    bits = 8 * min(map(len, [*left["sketch"], *right["sketch"]]))
    a, b = fold_parity(left["sketch"].tolist(), bits), fold_parity(right["sketch"].tolist(), bits)
    apart = np.zeros(len(i), dtype="int64")
    for at in range(0, len(i), 1 << 15):
        part = slice(at, at + (1 << 15))
        apart[part] = np.bitwise_count(a[i[part]] ^ b[j[part]]).sum(axis=1)
    keep = apart <= (n1 + n2 - 2 * need)[i, j]
    return i[keep], j[keep], apart[keep]


def forest(a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Places of the edges (a, b) of a spanning forest, the closest first."""
    names, code = np.unique(np.concatenate((a, b)), return_inverse=True)
    root = list(range(len(names)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    taken, left = [], len(names) - 1
    x, y = code[:len(a)].tolist(), code[len(a):].tolist()
    for k in np.argsort(apart, kind="stable").tolist():
        u, v = find(x[k]), find(y[k])
        if u != v:
            root[u] = v
            taken.append(k)
            left -= 1
            if not left:
                break
    return np.array(taken, dtype="int64")


def _tile(percent: int, sparse: bool):
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        same = key[1] == key[2]
        left = part[part["tile"] == key[1]]
        right = left if same else part[part["tile"] == key[2]]
        i, j, apart = tile_pairs(left, right, same, percent)
        if sparse and len(i):
            taken = forest(left["comp"].to_numpy()[i], right["comp"].to_numpy()[j], apart)
            i, j = i[taken], j[taken]
        a, b = left["key"].to_numpy()[i], right["key"].to_numpy()[j]
        return pd.DataFrame({"src": np.minimum(a, b) if len(a) else a, "dst": np.maximum(a, b) if len(b) else b})
    return run


def links(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, tile: int = TILE):
    """(members, edges): (doc_id, th, n_shingles, key) per document and the verified
    links (src, dst) between classes that connect each component."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = slim.select("doc_id", F.xxhash64("text").alias("th"), "text")
    both = materialize(hashed.mapInArrow(lambda b: _sets(b, size), "kind int, doc_id long, th long, n long, data binary"),
                       "sets")
    members = both.where("kind = 0").select("doc_id", "th", F.col("n").alias("n_shingles"), F.col("data").alias("key"))
    summed = both.where("kind = 1").select("n", "data").groupBy("n").applyInPandas(_sum_slices, "n long, data binary")
    found = {r["n"]: r["data"] for r in summed.collect()}
    shared = spark.sparkContext.broadcast(b"".join(found.get(k, bytes((1 << SKETCH_BITS) // 256)) for k in range(256)))

    own = slim.select("text").mapInArrow(_prefixes(shared, size, percent),
                                         "key binary, gid binary, n long, prefix array<bigint>")
    classes = materialize(own.dropDuplicates(["key"]), "classes")
    # a group goes by the name of its smallest class
    name = classes.groupBy("gid").agg(F.min("key").alias("rep"))
    owners = materialize(classes.select("key", "gid").join(name, "gid").select("key", "rep"), "owners")
    groups = classes.groupBy("gid").agg(F.min("key").alias("rep"), (F.count("*") > 1).alias("several"),
                                        F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    rows = groups.select("rep", "several", "n", F.posexplode("prefix").alias("pos", "token"))
    bucket = W.partitionBy("token")
    # a group of several classes keeps its first shingle even if no other group has it
    buckets = materialize(rows.withColumn("groups", F.count("*").over(bucket))
                          .where((F.col("groups") > 1) | (F.col("several") & (F.col("pos") == 0)))
                          .drop("groups"), "buckets")
    discard(classes)

    texts = _candidate_texts(hashed, members, owners, buckets)
    tried = first = _first_pairs(owners, buckets, percent)
    edges = _verified(tried, texts, size, percent)
    held, still = [first, texts, owners], None
    for number in range(FOREST_ROUNDS + 1):
        comps = materialize(connected_components(texts.select("key"), edges, "key"), "components")
        before, still = (buckets, _open_rows(owners, buckets, comps)) if still is None else \
            (still, _still_open(still, comps))
        discard(before)
        last = number == FOREST_ROUNDS
        pairs = _large_pairs(still, texts, size, percent, tile, not last)
        if last:
            pairs = pairs.unionByName(_small_pairs(still, percent))
        new = materialize(pairs.distinct().join(tried, ["src", "dst"], "left_anti"), "pairs")
        edges = edges.unionByName(_verified(new, texts, size, percent))
        tried = tried.unionByName(new)
        held += [new, comps]
    for stage in [*held, still]:
        discard(stage)
    return members, edges


def _candidate_texts(hashed: DataFrame, members: DataFrame, owners: DataFrame, buckets: DataFrame) -> DataFrame:
    """One text for each class that has a possible partner."""
    wanted = owners.join(buckets.select("rep").distinct(), "rep", "left_semi").select("key")
    place = members.join(wanted, "key", "left_semi").groupBy("key").agg(F.min(F.struct("th", "doc_id")).alias("at")) \
        .select("key", F.col("at.th").alias("k1"), F.col("at.doc_id").alias("k2"))
    # plain equal keys, so that repeated rows fall together without a second shuffle of texts
    at = ["th", "none", "id"]
    rows = hashed.select("th", F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text")
    place = place.select("key", F.col("k1").alias("th"), F.col("k2").isNull().alias("none"),
                         F.coalesce("k2", F.lit(0)).alias("id"))
    found = rows.join(place, at).dropDuplicates(at).select("key", "text")
    return materialize(found, "texts")


def _sketched(size: int):
    def make():
        shingler = Shingler(size)

        def work(batch: pa.RecordBatch) -> dict:
            return {"key": batch.column(0), "sketch": [parity(shingler(t)) for t in batch.column(1).to_pylist()]}
        return work
    return arrow_rows(make, pa.schema([("key", pa.binary()), ("sketch", pa.binary())]), 1024)


def _first_pairs(owners: DataFrame, buckets: DataFrame, percent: int) -> DataFrame:
    """Each group of a bucket with the bucket's smallest one, each class with its group's."""
    centre = buckets.groupBy("token").agg(F.min(F.struct("rep", "n", "pos")).alias("c"))
    need = F.ceil(percent * (F.col("n") + F.col("c.n")) / F.lit(100 + percent))
    room = F.least(F.col("n") - F.col("pos"), F.col("c.n") - F.col("c.pos"))
    across = buckets.join(centre, "token").where((F.col("c.rep") < F.col("rep")) & (room >= need)) \
        .select(F.col("c.rep").alias("src"), F.col("rep").alias("dst"))
    reps = buckets.where("several").select("rep").distinct()
    within = owners.join(reps, "rep").where(F.col("rep") < F.col("key")) \
        .select(F.col("rep").alias("src"), F.col("key").alias("dst"))
    return materialize(across.unionByName(within).distinct(), "pairs")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs that are similar enough.  Few pairs are broadcast, so that only the
    texts they name are shuffled; many are joined."""
    side = F.broadcast if pairs.count() <= BROADCAST_PAIRS else (lambda x: x)
    sources = side(pairs.select(F.col("src").alias("key")).distinct())
    left = texts.join(sources, "key", "left_semi").select(F.col("key").alias("src"), F.col("text").alias("a"))
    right = texts.select(F.col("key").alias("dst"), F.col("text").alias("b"))
    loaded = right.join(side(pairs), "dst").join(left, "src").select("src", "dst", "a", "b")
    return materialize(loaded.mapInArrow(_verify(size, percent), "src binary, dst binary"), "links")


def _open_rows(owners: DataFrame, buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """(token, pos, n, key, comp, rows): members of the buckets that hold several components."""
    member = owners.join(comps, "key").select("rep", "key", F.col("component").alias("comp"))
    rows = buckets.select("rep", "token", "pos", "n").join(member, "rep").drop("rep")
    several = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                        F.count("*").alias("rows")).where("lo != hi").select("token", "rows")
    return materialize(rows.join(several, "token"), "open")


def _still_open(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """The rows of ``_open_rows`` whose bucket holds several of the new components."""
    named = rows.drop("comp", "rows").join(comps.select("key", F.col("component").alias("comp")), "key")
    several = named.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                         F.count("*").alias("rows")).where("lo != hi").select("token", "rows")
    return materialize(named.join(several, "token"), "open")


def _small_pairs(still: DataFrame, percent: int) -> DataFrame:
    small = still.where(F.col("rows") <= SMALL_BUCKET)
    x, y = small.alias("x"), small.alias("y")
    need = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / F.lit(100 + percent))
    room = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    return x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.key") < F.col("y.key"))
                  & (F.col("x.comp") != F.col("y.comp")) & (room >= need)) \
        .select(F.col("x.key").alias("src"), F.col("y.key").alias("dst"))


def _large_pairs(still: DataFrame, texts: DataFrame, size: int, percent: int, tile: int, sparse: bool) -> DataFrame:
    """Pairs across components in tiles of about ``tile`` rows of a bucket a side.  Only
    the classes in these tiles need a parity sketch."""
    large = still.where(F.col("rows") > SMALL_BUCKET)
    sketches = texts.join(large.select("key").distinct(), "key", "left_semi").select("key", "text") \
        .mapInArrow(_sketched(size), "key binary, sketch binary")
    large = large.join(sketches, "key") \
        .withColumn("tiles", F.ceil(F.col("rows") / tile).cast("int")) \
        .withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
    dealt = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))) \
        .withColumns({"lo": F.least("tile", "other"), "hi": F.greatest("tile", "other")}) \
        .select("token", "lo", "hi", "tile", "key", "n", "pos", "comp", "sketch")
    return dealt.groupBy("token", "lo", "hi").applyInPandas(_tile(percent, sparse), "src binary, dst binary")


def labelled(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document its row of ``members`` and ``component``, a key that linked classes
    share (null for documents without shingles)."""
    members, edges = links(docs, size, percent)
    linked = edges.select(F.explode(F.array("src", "dst")).alias("key")).distinct()
    comp = materialize(connected_components(linked, edges, "key"), "components")
    empty = members.where("key IS NULL").withColumn("component", F.col("key"))
    return members.where("key IS NOT NULL").join(comp, "key", "left").select(
        "doc_id", "th", "n_shingles", "key", F.coalesce("component", "key").alias("component")).unionByName(empty)


def components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles and the smallest doc_id reachable by links."""
    rows = materialize(labelled(docs, size, percent), "labelled")
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    named = rows.where("component IS NOT NULL").join(least, "component")
    return named.select("doc_id", "n_shingles", F.col("least").alias("component_id")).unionByName(
        rows.where("component IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents of ``docs`` with one per component, that of the smallest id, then
    text hash; of rows equal in both, one.  Documents without shingles stay."""
    rows = materialize(labelled(docs, size, percent), "labelled").where("component IS NOT NULL")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    best = rows.groupBy("component").agg(F.min(at).alias("at"))
    copies = rows.groupBy("component", "doc_id", "th").agg(F.count("*").alias("copies"))
    kept = copies.join(best, "component").where(at == F.col("at")).select(
        F.col("doc_id").alias("__doc"), F.col("th").alias("__th"), F.col("copies").alias("__copies"))
    losers = rows.join(best, "component").where(at != F.col("at")).select(
        F.col("doc_id").alias("__doc"), F.col("th").alias("__th")).distinct().withColumn("__lost", F.lit(True))
    # a row is either kept, lost, or without shingles
    verdict = materialize(kept.unionByName(losers, allowMissingColumns=True), "verdict") \
        .where("__lost OR __copies > 1")
    hashed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__h": F.xxhash64(F.col("text").cast("string"))})
    judged = hashed.join(verdict, F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__h") == F.col("__th")), "left") \
        .where(F.col("__lost").isNull())
    if verdict.where("__copies > 1").isEmpty():
        return judged.select(*docs.columns)
    several = F.coalesce(F.col("__copies") > 1, F.lit(False))
    once = judged.where(~several).select(*docs.columns)
    return once.unionByName(judged.where(several).dropDuplicates(["__id", "__h"]).select(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at 4-word shingles and 85 % Jaccard similarity."""
    return components(read_table(spark, sf_dir, "documents"))
