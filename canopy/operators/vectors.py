"""Vector operators on ``ARRAY<DOUBLE>`` columns: distances, fusion,
exact epsilon-range pairs and exact k-nearest neighbours.

Range join without all pairs
----------------------------
Each vector is projected on ``m`` fixed random unit directions and binned
into cells of width ``radius``.  A projection is 1-Lipschitz, so two
vectors within ``radius`` of each other fall into the same or an adjacent
cell on every direction.  The middle of the grid's middle cell is the mean
projection, so vectors that lie closer than a cell is wide mostly share one.  The left side is exploded into its ``3^m``
neighbour cells, the right side keeps its own cell, and both are grouped
by cell.  Cells are cut into tiles of bounded size (see :func:`deal`),
which a kernel works off in small BLAS blocks, and candidate pairs are never
materialized as rows: only pairs within ``radius`` leave the kernel.  In a
cell of up to ``LEFT_TILES * MOST_ROWS`` rows a row is shuffled a fixed number
of times, so the shuffle grows with the rows and only the arithmetic with
their square.  Vectors that are floats in fact are moved as floats.  Exact for any data;
prunes well when the data is clustered.  The directions are a bounded
``m x d`` literal, never data-sized.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopy.operators.util import materialize

GRID_DIRECTIONS = 3
GRID_SEED = 42


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double(col) -> Column:
    return F.transform(_c(col), lambda x: x.cast("double"))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def sq_dist(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, v: acc + v)


def euclid(a, b) -> Column:
    """M5: Euclidean distance (sequential double sum)."""
    return F.sqrt(sq_dist(a, b))


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """M5: cosine similarity; 0 with a zero vector."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, dot(a, b) / scale).otherwise(0.0)


def fuse(a, b) -> Column:
    """M4: element-wise mean of a text and an image vector."""
    return F.zip_with(_c(a), _c(b), lambda x, y: (x + y) / 2.0)


def directions(dim: int, m: int = GRID_DIRECTIONS, seed: int = GRID_SEED) -> list[list[float]]:
    rng = np.random.default_rng(seed)
    d = rng.standard_normal((m, dim))
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    return d.tolist()


def _projections(vec: Column, dirs: list[list[float]]) -> list[Column]:
    return [dot(vec, F.array(*[F.lit(float(x)) for x in row])) for row in dirs]


def _cells(vec: Column, dirs: list[list[float]], radius: float, middle: list[float]) -> list[Column]:
    return [F.floor((p - F.lit(at)) / F.lit(radius) + F.lit(0.5)).cast("bigint")
            for p, at in zip(_projections(vec, dirs), middle, strict=True)]


def _laid(left: DataFrame, right: DataFrame, dirs: list[list[float]]) -> tuple[list[float], bool]:
    """The mean projections of the right vectors, and whether every number of both sides is a float."""
    vec = F.col("vec")
    means = [F.avg(F.when(F.abs(p) < 1e300, p)) for p in _projections(vec, dirs)]
    plain = F.bool_and(F.forall(vec, lambda x: x.eqNullSafe(x.cast("float").cast("double"))))
    *middle, one = right.agg(*means, plain).first()
    narrow = one and (left.select(vec).sameSemantics(right.select(vec)) or left.agg(plain).first()[0])
    return [at if at is not None else 0.0 for at in middle], bool(narrow)


#: Rows of a tile, up to so many left and right tiles in a cell; of larger cells the tiles grow
#: instead, to ``MOST_ROWS``, so a row is not copied more often only because there are more rows.
TILE, LEFT_TILES, RIGHT_TILES, MOST_ROWS = 1024, 4, 4, 65_536
#: Rows of one side of the distance matrix that a kernel holds at a time, and pairs measured at once.
BLOCK, PIECE = 1536, 65_536
BROADCAST_CELLS = 200_000


class Side:
    """The rows of one side of a tile pair: ids, their places in the order of all ids, vectors."""

    def __init__(self, rows: pa.Table, id_name: str, codes: np.ndarray):
        self.rows, self.ids, self.codes = rows, rows[id_name].combine_chunks(), codes
        self.x = np.asarray(rows["vec"].combine_chunks().flatten(), dtype=np.float64).reshape(len(codes), -1)
        self.sq = np.einsum("ij,ij->i", self.x, self.x)

    def column(self, name: str) -> np.ndarray:
        return self.rows[name].to_numpy()


def sides(batches: Iterator[pa.RecordBatch]) -> tuple[Side, Side] | None:
    """Both sides of a group that :func:`deal` made, each in the order of its ids; None where one is empty."""
    rows = pa.Table.from_batches(list(batches))
    left, right = rows.filter(rows["left"]), rows.filter(pc.invert(rows["left"]))
    if not left.num_rows or not right.num_rows:
        return None
    ids = [left["src"].combine_chunks(), right["dst"].combine_chunks()]
    if ids[0].type != ids[1].type:
        ids[0] = ids[0].cast(ids[1].type)
    codes = np.asarray(pc.rank(pa.concat_arrays(ids), tiebreaker="dense"), dtype=np.int64)
    out = []
    for side, name, code in ((left, "src", codes[:left.num_rows]), (right, "dst", codes[left.num_rows:])):
        order = np.argsort(code, kind="stable")
        out.append(Side(side.take(pa.array(order)), name, code[order]))
    return out[0], out[1]


def blocks(left: Side, right: Side) -> Iterator[tuple[slice, slice, np.ndarray, np.ndarray]]:
    """(left rows, right rows, squared distances, by how much those of a row may be off), block by block."""
    for i in range(0, len(left.sq), BLOCK):
        a = slice(i, i + BLOCK)
        for j in range(0, len(right.sq), BLOCK):
            b = slice(j, j + BLOCK)
            d2 = left.x[a] @ right.x[b].T
            d2 *= -2.0
            d2 += left.sq[a, None]
            d2 += right.sq[None, b]
            # cancellation grows with the norms
            yield a, b, d2, 1e-9 * (left.sq[a] + right.sq[b].max()) + 1e-12


def distances(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact distances of pairs of rows, in pieces of bounded size."""
    out = np.empty(len(i))
    for at in range(0, len(i), PIECE):
        diff = x[i[at:at + PIECE]] - y[j[at:at + PIECE]]
        out[at:at + PIECE] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return out


def _nearest(src: np.ndarray, dst: np.ndarray, dist: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` nearest pairs of each src, ties by dst."""
    order = np.lexsort((dst, dist, src))
    own = src[order]
    first = np.concatenate(([True], own[1:] != own[:-1])) if len(own) else np.empty(0, dtype=bool)
    rank = np.arange(len(own)) - np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))
    return order[rank < k]


def _found(left: Side, right: Side, i: np.ndarray, j: np.ndarray, dist: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([left.ids.take(pa.array(i)), right.ids.take(pa.array(j)), pa.array(dist)],
                                      names=["src", "dst", "dist"])


def _tile_pairs(radius: float, k: int | None = None):
    """Per-tile kernel: all (src, dst) within ``radius`` between two tiles, or the
    ``k`` nearest of them per left row.  It holds one block and what it keeps."""
    r2 = radius * radius

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(batches)
        if both is None:
            return
        yield from nearest(*both)
        if "mirror" in both[0].rows.column_names and both[0].rows["mirror"][0].as_py():
            yield from nearest(both[1], both[0])

    def nearest(left: Side, right: Side) -> Iterator[pa.RecordBatch]:
        held, at, bound = None, None, None
        for a, b, d2, off in blocks(left, right):
            off = off + 1e-9 * r2
            if a.start != at:
                if held is not None:
                    yield _found(left, right, *held)
                held, at, bound = None, a.start, np.full(len(d2), r2)
            limit = bound + off
            d2[left.codes[a, None] == right.codes[None, b]] = np.inf
            if k is not None and held is None and k < d2.shape[1]:
                limit = np.minimum(limit, np.partition(d2, k - 1, axis=1)[:, k - 1] + 2 * off)
            i, j = np.nonzero(d2 <= limit[:, None])
            i, j = i + a.start, j + b.start
            dist = distances(left.x, right.x, i, j)
            ok = dist <= radius
            i, j, dist = i[ok], j[ok], dist[ok]
            if k is None:
                for c in range(0, len(i), 16 * PIECE):
                    yield _found(left, right, i[c:c + 16 * PIECE], j[c:c + 16 * PIECE], dist[c:c + 16 * PIECE])
                continue
            if held is not None:
                i, j, dist = (np.concatenate(pair) for pair in zip(held, (i, j, dist), strict=True))
            best = _nearest(i, right.codes[j], dist, k)
            held = i[best], j[best], dist[best]
            rows, last = np.unique(held[0][::-1], return_index=True)
            full = np.bincount(held[0] - a.start, minlength=len(bound))[rows - a.start] >= k
            bound[rows[full] - a.start] = np.minimum(r2, held[2][::-1][last[full]] ** 2)
        if held is not None:
            yield _found(left, right, *held)

    return run


def range_pairs(left: DataFrame, right: DataFrame, radius: float, dim: int,
                key: str = "id", vec: str = "vec", m: int = GRID_DIRECTIONS,
                seed: int = GRID_SEED, tile: int = TILE, k: int | None = None) -> DataFrame:
    """All (src, dst, dist) with ``dist <= radius`` and src != dst; with
    ``k``, at most the ``k`` nearest per left row and tile leave a kernel.

    ``left`` and ``right`` have columns (key, vec ARRAY); keys keep their type.  A
    vector that is null or holds a null is near nothing.

    Left rows are exploded to their ``3^m`` neighbouring cells, right rows
    keep their own cell.  Per cell, both sides are cut into tiles (see
    :func:`deal`), and each (cell, left tile, right tile) group is worked off in
    bounded blocks by ``applyInArrow``.  A hot cell therefore becomes several
    tasks; only pairs within ``radius`` leave the kernel, batch by batch.  A table
    that is joined with itself is dealt by :func:`deal_self`, at half the copies.
    """
    met = deal_self(left.select(F.col(key).alias("src"), F.col(vec).alias("vec")), radius, dim, m, seed, tile) \
        if left is right else deal(left.select(F.col(key).alias("src"), F.col(vec).alias("vec")),
               right.select(F.col(key).alias("dst"), F.col(vec).alias("vec")), radius, dim, m, seed, tile)
    src, dst = (df.schema[key].dataType.simpleString() for df in (left, right))
    return met.applyInArrow(_tile_pairs(radius, k), f"src {src}, dst {dst}, dist double")


def _tiles(n: str, most: int, tile: int) -> Column:
    return F.least(F.ceil(F.col(n) / tile), F.greatest(F.lit(most), F.ceil(F.col(n) / MOST_ROWS))).cast("int")


def deal(left: DataFrame, right: DataFrame, radius: float, dim: int, m: int = GRID_DIRECTIONS,
         seed: int = GRID_SEED, tile: int = TILE):
    """Both sides of a range join in one table, grouped by (cell, left tile, right tile): rows of ``left``
    (src, vec and more columns) in their neighbouring cells, of ``right`` (dst, vec, ...) in their own."""
    dirs = directions(dim, m, seed)
    offsets = list(itertools.product((-1, 0, 1), repeat=m))
    shifts = F.array(*[F.array(*[F.lit(o) for o in off]) for off in offsets])
    whole = F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull())
    left, right = left.where(whole), right.where(whole)
    middle, narrow = _laid(left, right, dirs)
    lc = F.array(*_cells(F.col("vec"), dirs, radius, middle))
    lx = left.withColumn("_cell", F.explode(F.transform(shifts, lambda s: F.zip_with(lc, s, lambda a, b: a + b))))
    rx = right.withColumn("_cell", lc)
    if narrow:
        lx, rx = (df.withColumn("vec", F.col("vec").cast("array<float>")) for df in (lx, rx))
    rn = rx.groupBy("_cell").agg(F.count(F.lit(1)).alias("_nr"))
    ln = lx.groupBy("_cell").agg(F.count(F.lit(1)).alias("_nl"))

    sizes = materialize(ln.join(rn, "_cell").select("_cell", _tiles("_nl", LEFT_TILES, tile).alias("_tl"),
                                                    _tiles("_nr", RIGHT_TILES, tile).alias("_tr")), "cells")
    if sizes.count() <= BROADCAST_CELLS:
        sizes = F.broadcast(sizes)
    keys = ["_cell", "_lt", "_rt"]
    lt = (lx.join(sizes, "_cell")
          .withColumn("_lt", F.pmod(F.xxhash64("src"), F.col("_tl")).cast("int"))
          .withColumn("_rt", F.explode(F.sequence(F.lit(0), F.col("_tr") - 1)))
          .select(*keys, *left.columns, F.lit(True).alias("left")))
    rt = (rx.join(sizes, "_cell")
          .withColumn("_rt", F.pmod(F.xxhash64("dst"), F.col("_tr")).cast("int"))
          .withColumn("_lt", F.explode(F.sequence(F.lit(0), F.col("_tl") - 1)))
          .select(*keys, *right.columns, F.lit(False).alias("left")))
    return lt.unionByName(rt, allowMissingColumns=True).groupBy(*keys)


def deal_self(points: DataFrame, radius: float, dim: int, m: int = GRID_DIRECTIONS,
              seed: int = GRID_SEED, tile: int = TILE):
    """``points`` (src, vec and more columns) against themselves, dealt as by :func:`deal`, but two rows meet
    once, as left and right or as right and left: of two cells one is exploded to the other, and of two tiles
    of a cell the one of the lesser number is left.  ``mirror`` is false only where a tile meets itself."""
    dirs = directions(dim, m, seed)
    # the cell itself and half of its neighbours
    offsets = [off for off in itertools.product((-1, 0, 1), repeat=m) if off >= (0,) * m]
    shifts = F.array(*[F.array(*[F.lit(o) for o in off]) for off in offsets])
    points = points.where(F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull()))
    middle, narrow = _laid(points, points, dirs)
    placed = points.withColumn("_cell", F.array(*_cells(F.col("vec"), dirs, radius, middle)))
    if narrow:
        placed = placed.withColumn("vec", F.col("vec").cast("array<float>"))

    def near(df: DataFrame) -> DataFrame:
        cells = df.withColumn("_s", F.explode(shifts)).withColumn("_own", ~F.exists("_s", lambda o: o != 0))
        return cells.withColumn("_cell", F.zip_with("_cell", "_s", lambda a, b: a + b)).drop("_s")
    rn = materialize(placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_nr")), "cells")
    ln = near(rn).groupBy("_cell", "_own").agg(F.sum("_nr").alias("_nl"))
    sizes = materialize(ln.join(rn, "_cell").select(
        "_cell", "_own", _tiles("_nl", LEFT_TILES, tile).alias("_tl"),
        F.when(F.col("_own"), _tiles("_nr", LEFT_TILES, tile)).otherwise(_tiles("_nr", RIGHT_TILES, tile)).alias("_tr")), "cells")
    if sizes.count() <= BROADCAST_CELLS:
        sizes = F.broadcast(sizes)
    keys = ["_cell", "_own", "_lt", "_rt"]
    mirror = (~F.col("_own") | (F.col("_lt") != F.col("_rt"))).alias("mirror")
    zero = F.lit(0)
    lt = (near(placed).join(sizes, ["_cell", "_own"])
          .withColumn("_lt", F.pmod(F.xxhash64("src"), F.col("_tl")).cast("int"))
          .withColumn("_rt", F.explode(F.sequence(F.when(F.col("_own"), F.col("_lt")).otherwise(zero), F.col("_tr") - 1)))
          .select(*keys, *points.columns, mirror, F.lit(True).alias("left")))
    rt = (placed.join(sizes, "_cell")
          .withColumn("_rt", F.pmod(F.xxhash64("src"), F.col("_tr")).cast("int"))
          .withColumn("_lt", F.explode(F.sequence(zero, F.when(F.col("_own"), F.col("_rt")).otherwise(F.col("_tl") - 1))))
          .select(*keys, F.col("src").alias("dst"), *[c for c in points.columns if c != "src"], mirror, F.lit(False).alias("left")))
    return lt.unionByName(rt, allowMissingColumns=True).groupBy(*keys)


def knn(points: DataFrame, k: int, dim: int, radius: float, key: str = "id", vec: str = "vec") -> DataFrame:
    """Exact k nearest neighbours (src, dst, dist, rank), ties by dst.

    Round r finds all pairs within ``radius * 2^r`` for the points that
    still have fewer than ``k`` neighbours in range; a point with at least
    ``k`` neighbours inside the radius has its exact k-NN among them.
    Once the radius exceeds twice the largest norm every pair is in range, so
    the loop ends with every point answered.
    """
    if not radius > 0:
        raise ValueError("the first radius must be positive")
    max_norm = points.select(F.max(norm(vec)).alias("m")).first()["m"] or 0.0
    n_points = points.count()
    need = min(k, max(n_points - 1, 0))
    todo = points
    done = []
    r = radius
    while True:
        pairs = materialize(range_pairs(todo, points, r, dim, key, vec, k=k))
        final_r = r >= 2 * max_norm + 1e-9
        cnt = pairs.groupBy("src").agg(F.count(F.lit(1)).alias("_n"))
        ok = cnt if final_r else cnt.where(F.col("_n") >= need)
        w = Window.partitionBy("src").orderBy("dist", "dst")
        ranked = pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        done.append(materialize(ranked.join(ok.select("src"), "src", "left_semi")))
        if final_r:
            break
        todo = materialize(todo.join(ok.select(F.col("src").alias(key)), key, "left_anti"))
        if todo.limit(1).count() == 0:
            break
        r *= 2.0
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def unit(col) -> Column:
    """Scale to unit length (cosine distance becomes Euclidean); a zero vector stays."""
    c = _c(col)
    return F.when(norm(c) > 0, F.transform(c, lambda x: x / norm(c))).otherwise(c)

