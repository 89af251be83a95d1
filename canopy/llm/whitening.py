"""Embedding whitening by shifted Cholesky QR.

The centred rows A (n x d) are never moved.  A pass gives their Gram matrix; its
Cholesky factor R1, after a small shift of the diagonal, makes A R1^-1 nearly
orthogonal, and further passes over rows that go through the triangular solves of
all factors so far repeat that until the Gram matrix is the identity.  A = Q R
with R = Rk ... R1, so the singular values and right vectors of the small R are
those of A, without the squared condition of one covariance matrix.

What a task gives is one d x d block; blocks are added up in ``LANES`` groups in
Spark before the driver adds those.  The driver holds d x d matrices only.

Entries c become x = floor(1024 c) + 100000, exact integers.  Defined cases: rows
whose vector is null, empty, holds null or non-finite entries, or an entry whose x
lies beyond 2^52, have no x and are left out; of vectors of several lengths those
of the most frequent length count (the longer one of equals) and the others are
left out; components without variance (to rounding) are not returned, so equal
rows or one row alone give none; components of equal variance are any orthonormal
basis of their space; repeated rows and ids, null ids among them, count each; an
empty table gives no rows.  Every pass reads the table again: give a stored one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm.common import read_table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LANES = 64
PASSES = 8
#: Doubles of one block of rows.
BLOCK = 1 << 20
#: Singular values below this share of the largest are rounding.
NOISE = 1e-11
LARGEST = float(1 << 52)


def _vectors(batch: pa.RecordBatch, column: str, dim: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, x) of the usable rows, in blocks of one length each."""
    lists = batch.column(column)
    flat = np.asarray(lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
    size = np.asarray(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    start = np.cumsum(size) - size
    for d in np.unique(size) if dim is None else [dim]:
        rows = np.flatnonzero(size == d) if d else []
        for at in range(0, len(rows), step := max(1, BLOCK // max(1, int(d)))):
            some = rows[at:at + step]
            c = flat[start[some][:, None] + np.arange(d)]
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(SCALE * c) + SHIFT
                fit = (np.abs(x) <= LARGEST).all(axis=1)
            yield some[fit], x[fit].astype(np.int64)


def solve(a: np.ndarray, r: np.ndarray, block: int = 64) -> np.ndarray:
    """a r^-1 for an upper triangular r, column by column in blocks."""
    q = np.empty_like(a)
    for lo in range(0, len(r), block):
        hi = min(lo + block, len(r))
        q[:, lo:hi] = a[:, lo:hi] - q[:, :lo] @ r[:lo, lo:hi]
        for j in range(lo, hi):
            q[:, j] = (q[:, j] - q[:, lo:j] @ r[lo:j, j]) / r[j, j]
    return q


def _summed(df: DataFrame, block, kind: str) -> dict[int, np.ndarray]:
    """Sums by length of what ``block(batch)`` yields as (length, array)."""
    schema = pa.schema([("lane", pa.int32()), ("dim", pa.int32()), ("total", pa.binary())])

    def rows(lane: int, sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lane] * len(sums), pa.int32()), pa.array(list(sums), pa.int32()),
                                           pa.array([v.tobytes() for v in sums.values()], pa.binary())], schema=schema)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in block(batch):
                sums[dim] = sums[dim] + part if dim in sums else part
        yield rows(TaskContext.get().partitionId() % LANES, sums)

    def add(table: pa.Table) -> pa.Table:
        sums: dict[int, np.ndarray] = {}
        for dim, part in zip(table["dim"].to_pylist(), table["total"], strict=True):
            part = np.frombuffer(part.as_buffer(), kind)
            sums[dim] = sums[dim] + part if dim in sums else part.copy()
        return pa.Table.from_batches([rows(table["lane"][0].as_py(), sums)])

    ddl = "lane int, dim int, total binary"
    out: dict[int, np.ndarray] = {}
    for r in df.mapInArrow(tasks, ddl).groupBy("lane").applyInArrow(add, ddl).collect():
        part = np.frombuffer(r.total, kind)
        out[r.dim] = out[r.dim] + part if r.dim in out else part
    return out


@dataclass
class Whitening:
    """The fitted components: columns of ``vectors``, by falling variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    variances: np.ndarray
    trace: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - self.mean

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Exact sums of (n x - S)^2; objects only where longs do not hold them."""
        reach = max(abs(int(v)) for v in (x.max(), x.min())) * self.n + max(map(abs, self.sums))
        kind = np.int64 if reach * reach * len(self.sums) < 1 << 63 else object
        if kind is np.int64 or reach < 1 << 63:
            off = self.n * x - np.array(self.sums, np.int64)
            if kind is object and int(np.abs(off).max()) ** 2 * len(self.sums) < 1 << 63:
                kind = np.int64
            off = off.astype(kind)
        else:
            off = self.n * x.astype(object) - np.array(self.sums, object)
        return (off * off).sum(axis=1)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.variances)


def fit(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Fit on every usable row of ``df``; None where no component has variance."""
    slim = df.select(F.col(column).alias("v"))

    def totals(batch):
        for rows, x in _vectors(batch, "v"):
            # two halves, so that sums of longs stay exact
            if len(rows):
                yield x.shape[1], np.concatenate([[len(rows)], (x >> 20).sum(0), (x & ((1 << 20) - 1)).sum(0)])
    sums = _summed(slim, totals, "int64")
    if not sums:
        return None
    d = max(sums, key=lambda k: (int(sums[k][0]), k))
    n, high, low = int(sums[d][0]), sums[d][1:d + 1], sums[d][d + 1:]
    fitted = Whitening(n, [(int(a) << 20) + int(b) for a, b in zip(high, low, strict=True)], np.zeros((d, 0)),
                       np.zeros(0), 0.0, 0)
    factors: list[np.ndarray] = []
    r = np.eye(d)
    scale = None
    for fitted.passes in range(1, PASSES + 1):
        def gram(batch, factors=tuple(factors), scale=scale):
            for rows, x in _vectors(batch, "v", d):
                a = fitted.centred(x)
                if scale is not None:
                    a = a / scale
                for f in factors:
                    a = solve(a, f)
                if len(rows):
                    yield d, (a.T @ a).ravel()
        g = _summed(slim, gram, "float64")[d].reshape(d, d)
        if scale is None:
            # columns of one length: the shift is then small against every one of them
            scale = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))
            if not np.diag(g).any():
                return None
            g = g / scale / scale[:, None]
        off = np.abs(g - np.eye(d)).max()
        if factors and off < 1e-13 * d:
            break
        u = np.finfo(float).eps / 2
        if off > 0.5:
            # far from orthogonal: the shift keeps the factor positive, later passes undo its effect
            g_used = g + 11 * (n * d + d * (d + 1)) ** 0.5 * u * np.linalg.norm(g, 2) * np.eye(d)
        else:
            g_used = g
        factors.append(np.linalg.cholesky(g_used).T)
        r = factors[-1] @ r
    # what the last Gram matrix still differs from the identity (columns that depend on others stay below one)
    values, basis = np.linalg.eigh(g)
    root = basis * np.sqrt(np.clip(values, 0, None)) @ basis.T
    _, s, vt = np.linalg.svd(root @ r * scale)
    keep = min(components, int((s > NOISE * s[0]).sum()))
    v = vt[:keep].T
    # either sign will do: the largest entry is positive
    fitted.vectors = v * np.sign(v[np.abs(v).argmax(0), np.arange(keep)])
    fitted.variances, fitted.trace = s[:keep] ** 2 / n, float((s ** 2).sum() / n)
    return fitted


def identity_error(df: DataFrame, fitted: Whitening, column: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    d, k = fitted.vectors.shape

    def moments(batch):
        for rows, x in _vectors(batch, "v", d):
            w = fitted.whitened(x)
            if len(rows):
                yield 0, np.concatenate([w.sum(0), (w.T @ w).ravel()])
    got = _summed(df.select(F.col(column).alias("v")), moments, "float64")[0] / fitted.n
    mean, second = got[:k], got[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def transform(df: DataFrame, fitted: Whitening, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, deviation, whitened array) of every usable row; deviation is a decimal string, exact at any size."""
    d = fitted.vectors.shape[0]
    id_type = df.schema[id_column].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _vectors(batch, "v", d):
                if len(at):
                    w = fitted.whitened(x)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * w.shape[1], pa.int32()), w.ravel())
                    dev = pa.array([str(v) for v in fitted.deviation(x).tolist()], pa.string())
                    yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), dev, lists],
                                                     ["id", "deviation", "whitened"])
    return df.select(F.col(id_column).alias("id"), F.col(column).alias("v")) \
        .mapInArrow(rows, f"id {id_type}, deviation string, whitened array<double>") \
        .select(F.col("id").alias(id_column), "deviation", "whitened")


def report(df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component."""
    fitted = fit(df, components=components)
    if fitted is None:
        return df.where("false").select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("component", "int"), ("n", "long"), ("deviation", "long"), ("whitened", "double"),
            ("explained", "double"), ("identity_error", "double"))])
    error = identity_error(df, fitted)
    shares = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.variances])
    return transform(df, fitted).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitening of all embeddings."""
    return report(read_table(spark, sf_dir, "embeddings"))
