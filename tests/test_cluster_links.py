"""Clustering keeps links, not eps-edges, and a row of a range join is copied a fixed number of times."""

import numpy as np
from pyspark.sql import functions as F

from canopy.operators import cluster as C
from canopy.operators import vectors as V


def _points(spark, arr):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(arr)], "id long, vec array<double>")


def test_links_grow_with_points_not_edges(spark):
    rng = np.random.default_rng(3)
    pts = _points(spark, np.concatenate([rng.normal(scale=0.01, size=(300, 2)), rng.normal(scale=0.01, size=(200, 2)) + 50]))
    core = C.core_points(pts, 1.0, 3, 2)
    links = C.links(pts, core, [1.0], 2)
    tiles = 9
    assert core.count() == 500 and 498 <= links.count() <= tiles * 500 < C.eps_graph(pts, 1.0, 2).count()
    found = C.dbscan_star(pts, 1.0, 3, 2, core=core).groupBy("cluster").count().collect()
    assert sorted(map(tuple, found)) == [(0, 300), (300, 200)]


def test_rows_dealt_grow_with_the_input(spark):
    def dealt(n):
        arr = np.random.default_rng(n).normal(size=(n, 2)) / 100
        df = _points(spark, arr)
        both = V.deal(df.select(F.col("id").alias("src"), "vec"), df.select(F.col("id").alias("dst"), "vec"), 10.0, 2, tile=8)
        return both.count().agg(F.sum("count")).first()[0]
    small, large = dealt(400), dealt(1600)
    assert large <= 4.5 * small


def test_null_vectors_are_near_nothing(spark):
    pts = spark.createDataFrame([(0, [0.0, 0.0]), (1, [0.0, 0.1]), (2, None), (3, [None, 0.0])], "id long, vec array<double>")
    assert {(r.src, r.dst) for r in V.range_pairs(pts, pts, 1.0, 2).collect()} == {(0, 1), (1, 0)}


def test_a_table_meets_itself_at_half_the_copies(spark):
    """Two rows meet once, in one cell and across cells; the pairs are those of the join of two tables."""
    rng = np.random.default_rng(6)
    arr = np.concatenate([rng.normal(size=(400, 2)) / 100, rng.normal(size=(80, 2)) * 6])
    pts = _points(spark, np.concatenate([arr, arr[:3]]))
    pts = pts.unionByName(pts.where("id < 2"))

    def dealt(both):
        return both.count().agg(F.sum("count")).first()[0]
    own = dealt(V.deal_self(pts.select(F.col("id").alias("src"), "vec"), 1.5, 2, tile=8))
    two = dealt(V.deal(pts.select(F.col("id").alias("src"), "vec"), pts.select(F.col("id").alias("dst"), "vec"), 1.5, 2, tile=8))
    assert own <= 0.7 * two

    def pairs(k=None):
        return [sorted((r.src, r.dst, round(r.dist, 9)) for r in V.range_pairs(pts, right, 1.5, 2, tile=8, k=k).collect())
                for right in (pts, pts.select("*"))]
    a, b = pairs()
    assert a == b and len(a) > 1000
    near = [{(s, d) for s in {x[0] for x in found} for d in [min(x[2] for x in found if x[0] == s)]} for found in pairs(2)]
    assert near[0] == near[1]
