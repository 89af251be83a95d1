"""Connected components against union-find; long paths need few rounds."""

import math
import random

import pytest

from canopy.operators import components as C


def union_find(n, edges):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(n)}


def _graphs():
    rng = random.Random(3)
    yield "path", 1000, [(i, i + 1) for i in range(1, 999)] + [(999, 0)]
    yield "random", 400, [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    yield "hub", 300, [(7, i) for i in range(8, 300)]
    yield "none", 5, []


@pytest.mark.parametrize("name,n,edges", list(_graphs()), ids=lambda x: x if isinstance(x, str) else "")
def test_against_union_find(spark, monkeypatch, name, n, edges):
    rounds = []
    step = C._small_star
    monkeypatch.setattr(C, "_small_star", lambda e: rounds.append(1) or step(e))
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.id: r.component for r in C.connected_components(spark.range(n), df).collect()}
    assert got == union_find(n, edges)
    assert len(rounds) <= 2 * math.log2(n) + 2


def test_keys_of_any_type(spark):
    df = spark.createDataFrame([("b", "c"), ("c", "d")], "src string, dst string")
    nodes = spark.createDataFrame([(x,) for x in "abcd"], "id string")
    assert dict(C.connected_components(nodes, df).collect()) == {"a": "a", "b": "b", "c": "b", "d": "b"}
