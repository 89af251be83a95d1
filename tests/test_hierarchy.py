"""Multi-level density clustering: two groups of different density that a
single coarse eps merges are separated by stability selection."""

import numpy as np

from canopy.operators import cluster as C
from canopy.operators import hierarchy as H


def _points(spark, arr):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(arr)], "id long, vec array<double>")


def _data():
    gx, gy = np.meshgrid(np.arange(5), np.arange(8))
    grid = np.stack([gx.ravel(), gy.ravel()], axis=1).astype(float)
    dense = grid * 0.1                                 # 40 points, spacing 0.1
    loose = grid * 1.0 + np.array([3.0 + 0.4, 0.0])    # 40 points, spacing 1.0, 3 units away
    far = np.array([[100.0 + 50 * i, 100.0] for i in range(5)])
    return np.concatenate([dense, loose, far])


def test_two_densities(spark):
    pts = _points(spark, _data())
    eps = [0.3, 0.6, 1.2, 2.4, 4.8]
    got = {r.id: r.topic for r in H.hdbscan_topics(pts, eps, min_pts=4, min_cluster_size=10, dim=2).collect()}
    dense = {got[i] for i in range(40)}
    loose = {got[i] for i in range(40, 80)}
    assert len(dense) == 1 and len(loose) == 1 and dense != loose and -1 not in dense | loose
    assert [got[i] for i in range(80, 85)] == [-1] * 5
    # a single coarse cut merges the two groups
    flat = {r.id: r.cluster for r in C.dbscan_star(pts, 4.8, 4, 2).collect()}
    assert flat[0] == flat[40]


def test_single_level_equals_dbscan(spark):
    pts = _points(spark, _data())
    got = {r.id: r.topic for r in H.hdbscan_topics(pts, [1.2], min_pts=4, min_cluster_size=10, dim=2).collect()}
    flat = {r.id: r.topic for r in C.topics_from_clusters(C.dbscan_star(pts, 1.2, 4, 2), 10).collect()}
    groups = lambda d: sorted(sorted(k for k in d if d[k] == t) for t in set(d.values()))
    assert groups(got) == groups(flat)
