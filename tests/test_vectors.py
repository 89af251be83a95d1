"""Range join and kNN against brute force; DBSCAN* on planted blobs;
labels invariant under repartitioning; minimum topic size."""

import numpy as np
from pyspark.sql import functions as F

from canopy.operators import cluster as C
from canopy.operators import topics as TP
from canopy.operators import vectors as V


def _points(spark, arr):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(arr)], "id long, vec array<double>")


def test_range_pairs_exact(spark):
    rng = np.random.default_rng(1)
    arr = rng.normal(size=(120, 6))
    got = {(r.src, r.dst) for r in V.range_pairs(_points(spark, arr), _points(spark, arr), 2.0, 6).collect()}
    d = np.linalg.norm(arr[:, None] - arr[None], axis=2)
    want = {(i, j) for i in range(120) for j in range(120) if i != j and d[i, j] <= 2.0}
    assert got == want


def test_knn_exact(spark):
    rng = np.random.default_rng(2)
    arr = rng.normal(size=(80, 5))
    got = {(r.src, r["rank"]): r.dst for r in V.knn(_points(spark, arr), 4, 5, radius=0.3).collect()}
    d = np.linalg.norm(arr[:, None] - arr[None], axis=2)
    np.fill_diagonal(d, np.inf)
    for i in range(80):
        order = sorted(range(80), key=lambda j: (d[i, j], j))[:4]
        assert [got[(i, k + 1)] for k in range(4)] == order


def _blobs():
    rng = np.random.default_rng(7)
    centres = np.array([[0, 0], [20, 0], [0, 20]], dtype=float)
    blob = np.concatenate([c + rng.normal(scale=0.5, size=(40, 2)) for c in centres])
    far = np.array([[100 + 15 * i, -100 - 15 * i] for i in range(10)], dtype=float)
    return np.concatenate([blob, far])


def test_planted_blobs(spark):
    pts = _points(spark, _blobs())
    clusters = C.dbscan_star(pts, eps=1.5, min_pts=4, dim=2)
    topics = C.topics_from_clusters(clusters, 5).collect()
    labels = [r.topic for r in sorted(topics, key=lambda r: r.id)]
    assert sorted(set(labels)) == [-1, 0, 1, 2]
    assert labels[120:] == [-1] * 10
    for b in range(3):
        assert len(set(labels[40 * b:40 * (b + 1)]) - {-1}) == 1


def test_invariant_under_repartition(spark):
    pts = _points(spark, _blobs())
    a = C.dbscan_star(pts, 1.5, 4, 2).collect()
    b = C.dbscan_star(pts.repartition(7), 1.5, 4, 2).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_min_topic_size(spark):
    df = spark.createDataFrame([(i, 0 if i < 5 else 1) for i in range(9)], "doc_key long, topic int")
    got = dict(TP.min_topic_size(df, 5).collect())
    assert [got[i] for i in range(9)] == [0] * 5 + [-1] * 4


def test_connected_components_chain(spark):
    nodes = spark.range(0, 50).select(F.col("id"))
    edges = spark.range(0, 49).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    comp = C.connected_components(nodes, edges).collect()
    assert {r.component for r in comp} == {0}


def test_vectors_around_the_mean_share_a_cell_and_move_as_floats(spark):
    arr = np.random.default_rng(4).normal(size=(400, 6)).astype("float32") / 8 + 3

    def dealt(points):
        both = V.deal(points.select(F.col("id").alias("src"), "vec"), points.select(F.col("id").alias("dst"), "vec"), 5.0, 6, tile=8)
        kind = both._df.schema["vec"].dataType.simpleString()
        return both.count().agg(F.sum("count")).first()[0], kind
    rows, kind = dealt(_points(spark, arr))
    assert rows <= (V.LEFT_TILES + V.RIGHT_TILES) * 400 and kind == "array<float>"
    # a number that no float holds, on one side
    odd = arr.astype("float64")
    odd[7, 2] += 1e-12
    assert dealt(_points(spark, odd))[1] == "array<double>"


def test_vectors_without_a_mean(spark):
    big = [[1e308, 0.0], [1.5, 0.25], [1.5, 0.5], [float("nan"), 1.0]]
    pts = _points(spark, big)
    assert {(r.src, r.dst) for r in V.range_pairs(pts.where("id in (1, 2, 3)"), pts.where("id < 3"), 1.0, 2).collect()} == {(1, 2), (2, 1)}
    assert V.range_pairs(pts.where("false"), pts, 1.0, 2).count() == 0
