"""The exact density tree against brute force: Kruskal over all pairs, splits from above, excess of mass."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from canopy.operators import density_tree as D

VECTORS = "/root/testdata/sf0.1/embeddings.parquet"


def reachability(x, min_pts):
    d = np.array([np.sqrt(np.einsum("ij,ij->i", x - v, x - v)) for v in x])
    core = np.sort(d, axis=1)[:, min(min_pts - 1, len(x) - 1)]
    return np.maximum(d, np.maximum(core[:, None], core[None, :]))


def kruskal(ids, w):
    n = len(ids)
    root = list(range(n))

    def find(v):
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v
    i, j = np.triu_indices(n, 1)
    lo, hi = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
    out = []
    for e in np.lexsort((hi, lo, w[i, j])).tolist():
        a, b = find(int(i[e])), find(int(j[e]))
        if a != b:
            root[a] = b
            out.append((float(w[i[e], j[e]]), int(lo[e]), int(hi[e])))
    return out


def from_above(ids, edges, m):
    """{id: (members of its selected cluster, probability)} by taking the heaviest edges away."""
    links = {}
    for e in edges:
        links.setdefault(e[1], set()).add(e)
        links.setdefault(e[2], set()).add(e)

    def side(start, alive):
        seen, todo = {start}, [start]
        while todo:
            for e in links.get(todo.pop(), ()):
                if e in alive:
                    for v in e[1:]:
                        if v not in seen:
                            seen.add(v)
                            todo.append(v)
        return seen

    def lam(w):
        return min(1 / w, D.MOST) if w > 0 else D.MOST

    def grow(members, own, birth, is_root):
        """(best mass, chosen clusters) of a condensed cluster; each is (members, {id: lambda}, death)."""
        everyone, gone, mass, death = set(members), {}, 0.0, 0.0
        alive = set(own)
        for e in sorted(own, reverse=True):
            if e not in alive:
                continue
            alive.discard(e)
            parts = [side(e[1], alive), side(e[2], alive)]
            at = lam(e[0])
            if all(len(p) >= m for p in parts):
                mass += sum(len(p) * (at - birth) for p in parts)
                kids = [grow(p, [x for x in alive if x[1] in p], at, False) for p in parts]
                below, chosen = sum(k[0] for k in kids), [c for k in kids for c in k[1]]
                death = max(death, at)
                break
            small = [p for p in parts if len(p) < m]
            for p in small:
                for v in p:
                    gone[v] = at
                mass += len(p) * (at - birth)
                death = max(death, at)
            if len(small) == 2:
                below, chosen = None, []
                break
            members = next(p for p in parts if len(p) >= m)
            alive = {x for x in alive if x[1] in members}
        if not is_root and (below is None or mass >= below):
            return mass, [(everyone, gone, death)]
        return below or 0.0, chosen
    if len(ids) < m:
        return {}
    _, chosen = grow(set(ids.tolist()), edges, 0.0, True)
    return {v: (frozenset(c[0]), c[1].get(v), c[2]) for c in chosen for v in c[0]}


def check(spark, x, ids, min_pts, m, radius, **more):
    df = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "id long, vec array<double>")
    tree, rounds = D.spanning_tree(df, min_pts, x.shape[1], radius, k=more.pop("k", 15))
    want = kruskal(ids, reachability(x, min_pts))
    got = sorted((r.w, r.lo, r.hi) for r in tree.collect())
    assert [e[1:] for e in got] == [e[1:] for e in sorted(want)]
    assert np.allclose([e[0] for e in got], [e[0] for e in sorted(want)], rtol=1e-12)
    assert rounds <= math.log2(max(2, len(ids))) + 1
    rows = D.density_clusters(df, min_pts, m, x.shape[1], radius, **more).collect()
    found = {r.id: (r.cluster, r.probability) for r in rows if r.cluster is not None}
    same_as_from_above(found, from_above(ids, want, m))
    assert len(rows) == len(ids) and all(r.probability == 0 for r in rows if r.cluster is None)
    return rows


def kernel(ids, edges, m):
    """Clusters and probabilities from the merge kernel alone, all edges in one window."""
    e = pd.DataFrame([(k, w, a, b) for k, (w, a, b) in enumerate(edges)], columns=["pos", "w", "a", "b"])
    c = pd.DataFrame({"label": ids, "size": 1, "cluster": None, "mass": 0.0, "kids": None, "death": 0.0})
    out = D._merge(m, True)(e, c)
    table = out[out.kind == "cluster"].set_index("cluster")

    def top(c):
        best = None
        while c is not None and not pd.isna(c):
            if table.sel[c] and not pd.isna(table.parent[c]):
                best = c
            c = table.parent[c]
        return best
    found = {}
    for r in out[out.kind == "left"].itertuples():
        if (t := top(r.cluster)) is not None:
            found[int(r.label)] = (t, min(1.0, r.lam / table.death[t]))
    return found


def same_as_from_above(found, brute):
    groups = {}
    for v, (t, _) in found.items():
        groups.setdefault(t, set()).add(v)
    assert {frozenset(g) for g in groups.values()} == {b[0] for b in brute.values()}
    for v, (_, p) in found.items():
        _, at, death = brute[v]
        assert p == pytest.approx(1.0 if at is None else min(1.0, at / death), rel=1e-9)


@pytest.mark.parametrize("seed", range(25))
def test_merges_against_splits_from_above(seed):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(rng.uniform(-6, 6, 2), rng.choice([0.05, 0.3, 1.0]), (int(rng.integers(5, 40)), 2)) for _ in range(4)])
    if seed % 5 == 0:
        x = np.round(x)
    ids = rng.permutation(len(x)) + 10
    edges, m = kruskal(ids, reachability(x, 4)), int(rng.integers(2, 14))
    same_as_from_above(kernel(ids, edges, m), from_above(ids, edges, m))


def blobs(seed=1):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(0, 0.1, (60, 2)), rng.normal(0, 1, (60, 2)) + [8, 0], rng.normal(0, 0.1, (40, 2)) + [0, 1.2],
                        rng.uniform(-20, 20, (25, 2))])
    return x, rng.permutation(len(x)) * 7 + 3_000_000_000


def test_blobs_of_two_densities(spark):
    x, ids = blobs()
    rows = check(spark, x, ids, 5, 12, 6.0)
    assert len({r.cluster for r in rows} - {None}) >= 3


def test_windows_give_the_same_tree(spark):
    x, ids = blobs(2)
    check(spark, x[:130], ids[:130], 4, 10, 6.0, window=50, k=4)


def test_copies_and_ties(spark):
    grid = np.array([(i, j) for i in range(6) for j in range(6)], float)
    x = np.concatenate([grid, grid[:10], grid + [30, 0], np.zeros((30, 2)) + [60, 60]])
    check(spark, x, np.arange(len(x)), 3, 8, 4.0, k=3)


def test_small_sets(spark):
    for n in (1, 2, 5):
        df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(n)], "id long, vec array<double>")
        rows = D.density_clusters(df, 3, 6, 2, 1.0).collect()
        assert len(rows) == n and all(r.cluster is None and r.probability == 0 for r in rows)
    assert D.density_topics(df.where("false"), 3, 6, 2, 1.0).count() == 0


def test_single_cluster_where_allowed(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(40, 2)))], "id long, vec array<double>")
    topics = D.density_topics(df, 4, 35, 2, 0.5, allow_single=True)
    assert topics.where(F.col("topic") == 0).count() == 40


def test_given_vectors(spark):
    rows = spark.read.parquet(VECTORS).select("vec_id", "embedding").collect()
    x = np.array([r.embedding for r in rows], dtype="float64")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    check(spark, x, np.array([r.vec_id for r in rows]), 5, 20, 1.1)
