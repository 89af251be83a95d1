import numpy as np
import pytest
from pyspark.sql import functions as F

from canopy.llm import whitening as W
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors):
    """n, sums, eigenvalues, vectors and deviations from numpy's symmetric solver."""
    x = np.floor(1024 * np.array(vectors, "float32").astype(float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    a = x - s / n
    e, v = np.linalg.eigh(a.T @ a / n)
    return n, s, e[::-1], v[:, ::-1], ((n * x - s) ** 2).sum(1), a


def check(df, vectors, components=8):
    n, s, e, v, dev, a = brute(vectors)
    rows = W.report(df).collect()
    k = min(components, int((e > 1e-9 * e[0]).sum()))
    assert len(rows) == n * k and {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1
    assert rows[0].identity_error < 1e-9
    got = {}
    for r in rows:
        got.setdefault(r.component, []).append((r.deviation, r.whitened))
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-9)
    assert sorted(got) == list(range(1, k + 1))
    for c, values in got.items():
        want = a @ v[:, c - 1] / np.sqrt(e[c - 1])
        values.sort()
        sign = [sorted(zip(dev.tolist(), (f * want).tolist(), strict=True)) for f in (1, -1)]
        assert any(np.allclose(values, x, rtol=1e-7, atol=1e-7) for x in sign)


def test_against_a_symmetric_solver(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").repartition(5)
    check(df, [r.embedding for r in df.collect()])


def test_odd_rows_are_left_out_and_repeats_count(spark):
    rng = np.random.default_rng(1)
    good = [(int(i % 30), [float(np.float32(v)) for v in rng.normal(size=12)], None) for i in range(60)]
    good += [good[0], (None, good[3][1], 1)]
    bad = [(1, None, 1), (2, [], 1), (3, [1.0] * 11 + [None], 1), (4, [float("nan")] + [0.0] * 11, 1),
           (5, [float("inf")] * 12, 1), (6, [1.0] * 5, 1), (7, [1e30] * 12, 1)]
    df = spark.createDataFrame(good + bad, SCHEMA).repartition(3).withColumns({c: F.lit("x") for c in ("n", "v", "id", "lane")})
    check(df, [g[1] for g in good])


def test_dependent_and_constant_columns(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-2000, 2000, size=(80, 4)) / 1024
    vectors = [[float(v) for v in (*row, row[0], 0.5, row[0] + row[1], 1e4 * row[2])] for row in base]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)
    check(df, vectors)


def test_nearly_dependent_columns_need_the_shift(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 1)) * 1e6
    vectors = (base + rng.integers(-3, 4, size=(300, 6)) / 1024).astype("float64").tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    fitted = W.fit(df)
    x = np.floor(1024 * np.array(vectors)) + 100_000
    s = np.linalg.svd(x - x.mean(0), compute_uv=False)
    assert fitted.passes > 2 and np.allclose(fitted.variances, s ** 2 / 300, rtol=1e-6)
    assert W.identity_error(df, fitted) < 1e-6


def test_no_variance_gives_no_rows(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0], 0)] * 4, SCHEMA)
    assert W.report(one).count() == 0 and W.report(one.where("false")).count() == 0
    assert W.report(one).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_longs():
    fitted = W.Whitening(10 ** 9, [10 ** 14 + 7, -5], np.zeros((2, 0)), np.zeros(0), 0.0, 0)
    x = np.array([[123456, -99], [5, 7]])
    assert fitted.deviation(x).tolist() == [sum((10 ** 9 * a - s) ** 2 for a, s in zip(r, fitted.sums, strict=True))
                                            for r in x.tolist()]
