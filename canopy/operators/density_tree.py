"""Exact density tree (TM5) and membership (TM13): HDBSCAN with continuous lambda.

1. Mutual reachability: max(distance, core distances), a core distance being that
   to the (min_pts - 1)-th other point, from the exact nearest neighbours.
2. Minimum spanning tree by Boruvka rounds.  A component's least outgoing edge comes
   from the neighbour lists where that is certain (it is shorter than the reach of
   all the component's lists).  Only points whose reach does not settle it search the
   tiles of a range join, whose kernel gives one edge per component and tile.  Edges
   have a total order (weight, smaller id, greater id), so equal weights close no
   cycle, and components at least halve: at most log2(n) + 1 rounds.
3. Condensed tree: edges, numbered in that order, are merged in windows.  The edges of
   a window join components of the windows before, and its connected groups are
   merged side by side, one bounded task each.  Two components of ``min_cluster_size``
   or more that meet become children of a new cluster; smaller ones fall out of the
   greater one (or start a cluster where both are small) at lambda = 1 / weight.
   Excess of mass is known when a cluster ends, so selection from below happens there.
4. The topmost selected ancestor of every cluster is found by pointer doubling.

Ids are longs.  Weights of zero (copies) have lambda ``MOST``.  A set smaller than
``min_cluster_size`` is all noise; the root is selected only with ``allow_single``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.operators import vectors as V
from canopy.operators.components import connected_components
from canopy.operators.records import global_index
from canopy.operators.util import discard, materialize

MOST = 1e200
WINDOW = 1_000_000
_EDGE = "comp long, w double, lo long, hi long, other long"


def _least(df: DataFrame) -> DataFrame:
    """The least outgoing edge of each component."""
    return df.groupBy("comp").agg(F.min(F.struct("w", "lo", "hi", "other")).alias("e")).select("comp", "e.*")


def _least_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per component of a left tile, its least edge to other components in a right tile."""
    both = V.sides(batches)
    if both is None:
        return
    left, right = both
    (ca, cb), (own, other) = ((left.column(c), right.column(c)) for c in ("core", "comp"))
    src, dst = (np.asarray(side.ids, dtype=np.int64) for side in both)
    names, at = np.unique(own, return_inverse=True)
    best, found = np.full(len(names), np.inf), None
    for a, b, d2, off in V.blocks(left, right):
        about = np.maximum(np.sqrt(np.clip(d2, 0, None)), np.maximum(ca[a, None], cb[None, b]))
        about[own[a, None] == other[None, b]] = np.inf
        np.minimum.at(best, at[a], about.min(axis=1))
        # the product rounds: all pairs about as short are measured exactly
        slack = 1e-6 * (np.sqrt(left.sq[a].max() + right.sq[b].max()) + 1e-300)
        i, j = np.nonzero((about <= best[at[a]][:, None] + slack) & np.isfinite(about))
        if not len(i):
            continue
        i, j = i + a.start, j + b.start
        w = np.maximum(V.distances(left.x, right.x, i, j), np.maximum(ca[i], cb[j]))
        out = pd.DataFrame({"comp": own[i], "w": w, "lo": np.minimum(src[i], dst[j]), "hi": np.maximum(src[i], dst[j]), "other": other[j]})
        found = out if found is None else pd.concat([found, out])
        found = found.sort_values(["comp", "w", "lo", "hi"]).drop_duplicates("comp")
    if found is not None:
        yield pa.RecordBatch.from_pandas(found, preserve_index=False)


def spanning_tree(points: DataFrame, min_pts: int, dim: int, radius: float, k: int = 15,
                  key: str = "id", vec: str = "vec") -> tuple[DataFrame, int]:
    """((w, lo, hi), rounds): the minimum spanning tree under mutual reachability."""
    pts = materialize(points.select(F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("vec")), "points")
    n = pts.count()
    k = max(k, min_pts - 1)
    near = materialize(V.knn(pts, k, dim, radius), "near")
    core_rank = min(min_pts - 1, n - 1)
    # lists of all other points leave nothing out
    reach = F.when(F.count("*") >= n - 1, F.lit(float("inf"))).otherwise(F.max("dist"))
    core = near.groupBy(F.col("src").alias("id")).agg(
        F.max(F.when(F.col("rank") == core_rank, F.col("dist"))).alias("core"), reach.alias("reach"))
    info = materialize(pts.select("id").join(core, "id", "left").select(
        "id", F.coalesce("core", F.lit(0.0)).alias("core"), F.coalesce("reach", F.lit(float("inf"))).alias("reach")), "info")
    side = info.select("id", "core")
    edges = near.join(side.toDF("src", "ca"), "src").join(side.toDF("dst", "cb"), "dst").select(
        "src", "dst", F.greatest("dist", "ca", "cb").alias("w"))
    edges = materialize(edges.select(F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi"), "w").distinct(), "edges")
    widest = 2 * (pts.select(F.max(V.norm("vec"))).first()[0] or 0.0) + 1e-9
    comps = materialize(pts.select("id", F.col("id").alias("comp")), "comps")
    tree, rounds = [], 0
    while comps.select("comp").distinct().count() > 1:
        rounds += 1
        ends = edges.join(comps.toDF("lo", "cl"), "lo").join(comps.toDF("hi", "ch"), "hi").where("cl != ch")
        edges_now = materialize(ends, "edges")
        both = edges_now.select(F.col("cl").alias("comp"), "w", "lo", "hi", F.col("ch").alias("other")).unionByName(
            edges_now.select(F.col("ch").alias("comp"), "w", "lo", "hi", F.col("cl").alias("other")))
        found = _least(both)
        placed = comps.join(info, "id")
        doubt = materialize(placed.join(found.select("comp", "w"), "comp", "left")
                            .where(F.col("w").isNull() | (F.col("reach") <= F.col("w"))).select("id", "core", "comp", "w"), "doubt")
        most = doubt.agg(F.count("*").alias("n"), F.max(F.coalesce("w", F.lit(widest))).alias("w")).first()
        if most.n:
            # pairs beyond a component's edge cannot beat it; ties at it are looked at
            left = doubt.drop("w").join(pts, "id").select(F.col("id").alias("src"), "vec", "core", "comp")
            right = placed.join(pts, "id").select(F.col("id").alias("dst"), "vec", "core", "comp")
            met = V.deal(left, right, min(float(most.w), widest) + 1e-9 * widest + 1e-300, dim)
            found = _least(found.select("comp", "w", "lo", "hi", "other").unionByName(met.applyInArrow(_least_out, _EDGE)))
        chosen = materialize(found, "chosen")
        tree.append(chosen)
        merged = connected_components(comps.select(F.col("comp").alias("id")).distinct(),
                                      chosen.select(F.col("comp").alias("src"), F.col("other").alias("dst")), "id")
        after = materialize(comps.join(merged.toDF("comp", "to"), "comp").select("id", F.col("to").alias("comp")), "comps")
        for stage in (comps, doubt, edges):
            discard(stage)
        # edges inside a component are of no more use
        comps, edges = after, edges_now.select("lo", "hi", "w")
        edges.stage_path = edges_now.stage_path
    out = points.sparkSession.createDataFrame([], "w double, lo long, hi long")
    for chosen in tree:
        out = out.unionByName(chosen.select("w", "lo", "hi"))
    out = materialize(out.distinct(), "tree")
    for stage in (*tree, pts, near, info, comps, edges):
        discard(stage)
    return out, rounds


_EVENT = ("kind string, label long, target long, cluster long, parent long, lam double, size long, mass double, "
          "kids double, sel boolean, death double")


def _merge(m: int, last: bool):
    """Kernel: the edges of one group of a window, in order, over its components."""
    def run(edges: pd.DataFrame, comps: pd.DataFrame) -> pd.DataFrame:
        events: list[tuple] = []
        root = {v: v for v in comps["label"].tolist()}
        # size, cluster, mass (sum of lambda over what left), best of its children, lambda of its end, small parts
        state = {r.label: [r.size, None if pd.isna(r.cluster) else int(r.cluster), r.mass, None if pd.isna(r.kids) else r.kids, r.death,
                           [r.label] if pd.isna(r.cluster) else []] for r in comps.itertuples(index=False)}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def ended(s: list, parent: int | None, lam: float) -> float:
            own = s[2] - lam * s[0]
            sel = s[3] is None or own >= s[3]
            events.append(("cluster", None, None, s[1], parent, lam, s[0], own, s[3], sel, s[4]))
            return own if sel else s[3]
        for pos, w, x, y in edges.sort_values("pos")[["pos", "w", "a", "b"]].itertuples(index=False):
            x, y = find(x), find(y)
            lam = min(1.0 / w, MOST) if w > 0 else MOST
            a, b = state.pop(x), state.pop(y)
            size, parts = a[0] + b[0], a[5] + b[5]
            if a[1] is None and b[1] is None:
                new = [size, None, 0.0, None, 0.0, parts]
                if size >= m:
                    events.extend(("left", p, None, int(pos), None, lam, None, None, None, None, None) for p in parts)
                    new = [size, int(pos), lam * size, None, lam, []]
            elif a[1] is not None and b[1] is not None:
                new = [size, int(pos), lam * size, ended(a, int(pos), lam) + ended(b, int(pos), lam), lam, []]
            else:
                big, small = (a, b) if a[1] is not None else (b, a)
                events.extend(("left", p, None, big[1], None, lam, None, None, None, None, None) for p in small[5])
                new = [size, big[1], big[2] + lam * small[0], big[3], big[4], []]
            keep, gone = min(x, y), max(x, y)
            root[gone] = keep
            state[keep] = new
        for label, s in state.items():
            if last and s[1] is not None:
                ended(s, None, 0.0)
            events.append(("state", label, None, s[1], None, None, s[0], s[2], s[3], None, s[4]))
        events.extend(("map", v, find(v), None, None, None, None, None, None, None, None) for v in root)
        return pd.DataFrame(events, columns=[c.split()[0] for c in _EVENT.split(", ")])
    return run


def condense(ids: DataFrame, tree: DataFrame, min_cluster_size: int, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """((id, cluster, lam) of the points that are in any cluster, (cluster, parent, lam, size, mass, sel, death))."""
    if min_cluster_size < 2:
        raise ValueError("a cluster has two points at least")
    edges = materialize(global_index(tree, ["w", "lo", "hi"], "pos"), "numbered")
    windows = -(-edges.count() // window)
    labels = materialize(ids.select("id", F.col("id").alias("label")), "labels")
    none = F.lit(None)
    comps = materialize(ids.select(F.col("id").alias("label"), F.lit(1).cast("long").alias("size"), none.cast("long").alias("cluster"),
                                   F.lit(0.0).alias("mass"), none.cast("double").alias("kids"), F.lit(0.0).alias("death")), "states")
    left, clusters = [], []
    for i in range(windows):
        own = edges.where((F.col("pos") >= i * window) & (F.col("pos") < (i + 1) * window))
        own = materialize(own.join(labels.toDF("lo", "a"), "lo").join(labels.toDF("hi", "b"), "hi").select("pos", "w", "a", "b"), "window")
        nodes = own.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        groups = nodes.withColumn("component", F.lit(0).cast("long")) if windows == 1 else connected_components(
            nodes, own.select(F.col("a").alias("src"), F.col("b").alias("dst")), "id")
        groups = materialize(groups.toDF("label", "grp"), "groups")
        grouped = own.join(groups.toDF("a", "eg"), "a").groupBy("eg")
        met = grouped.cogroup(comps.join(groups.toDF("label", "cg"), "label").groupBy("cg"))
        events = materialize(met.applyInPandas(_merge(min_cluster_size, i == windows - 1), _EVENT), "events")
        left.append(events.where("kind = 'left'").select("label", "cluster", "lam").join(labels, "label").select("id", "cluster", "lam"))
        left[-1] = materialize(left[-1], "left")
        clusters.append(materialize(events.where("kind = 'cluster'").select("cluster", "parent", "lam", "size", "mass", "sel", "death"), "clusters"))
        moved = events.where("kind = 'map'").select("label", "target")
        new_labels = materialize(labels.join(moved, "label", "left").select("id", F.coalesce("target", "label").alias("label")), "labels")
        cols = comps.columns
        new_comps = materialize(comps.join(groups, "label", "left_anti").select(cols).unionByName(
            events.where("kind = 'state'").select(cols)), "states")
        for stage in (own, groups, events, labels, comps):
            discard(stage)
        labels, comps = new_labels, new_comps
    if not windows:
        return (ids.where("false").select("id", F.lit(0).cast("long").alias("cluster"), F.lit(0.0).alias("lam")),
                ids.where("false").select(F.lit(0).cast("long").alias("cluster"), F.lit(0).cast("long").alias("parent"), F.lit(0.0).alias("lam"),
                                          F.lit(0).cast("long").alias("size"), F.lit(0.0).alias("mass"), F.lit(True).alias("sel"), F.lit(0.0).alias("death")))
    points, table = left[0], clusters[0]
    for a, b in zip(left[1:], clusters[1:], strict=True):
        points, table = points.unionByName(a), table.unionByName(b)
    return points, table


def selected(clusters: DataFrame, allow_single: bool = False) -> DataFrame:
    """(cluster, top): the topmost selected cluster that each cluster lies in or is; none where there is none."""
    may = F.col("sel") & (F.lit(allow_single) | F.col("parent").isNotNull())
    now = materialize(clusters.select("cluster", F.col("parent").alias("up"), F.when(may, F.col("cluster")).alias("top")), "tops")
    while now.where("up IS NOT NULL").limit(1).count():
        above = now.select(F.col("cluster").alias("up"), F.col("up").alias("next"), F.col("top").alias("higher"))
        turned = materialize(now.join(above, "up", "left").select(
            "cluster", F.col("next").alias("up"), F.coalesce("higher", "top").alias("top")), "tops")
        discard(now)
        now = turned
    return now.select("cluster", "top")


def density_clusters(points: DataFrame, min_pts: int, min_cluster_size: int, dim: int, radius: float, k: int = 15,
                     window: int = WINDOW, allow_single: bool = False) -> DataFrame:
    """(id, cluster, probability) of every point: the selected cluster (null for noise) and
    lambda / largest lambda of the cluster, at most 1 (0 for noise)."""
    tree, _ = spanning_tree(points, min_pts, dim, radius, k)
    left, clusters = condense(points.select("id"), tree, min_cluster_size, window)
    top = selected(clusters, allow_single).join(clusters.select(F.col("cluster").alias("top"), "death"), "top")
    own = left.join(top, "cluster").select("id", F.col("top").alias("cluster"),
                                           F.least(F.lit(1.0), F.try_divide("lam", "death")).alias("probability"))
    return points.select("id").join(own, "id", "left").select("id", "cluster", F.coalesce("probability", F.lit(0.0)).alias("probability"))


def density_topics(points: DataFrame, min_pts: int, min_cluster_size: int, dim: int, radius: float, **more) -> DataFrame:
    """(id, topic, probability): selected clusters renumbered by size, -1 for noise."""
    from canopy.operators import topics as TP
    found = materialize(density_clusters(points, min_pts, min_cluster_size, dim, radius, **more), "density")
    topics = TP.renumber(found.select("id", F.coalesce("cluster", F.lit(-1).cast("long")).alias("topic")), "id")
    return topics.join(found.select("id", "probability"), "id")
