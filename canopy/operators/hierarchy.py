"""Multi-level density clustering: a discrete HDBSCAN (TM5, eps grid with
stability selection).

HDBSCAN (Campello et al. 2013) builds the tree of DBSCAN* clusters over
all density levels, condenses it (a cluster that only sheds points keeps its
identity; a split into two or more clusters of at least
``min_cluster_size`` starts new clusters) and selects the clusters with the
largest *excess of mass*: ``S(K) = integral of |K(lambda)| d lambda`` with
``lambda = 1/eps``.  Here the density axis is a fixed grid of eps levels:

1. core distances and the links between core points of all levels, in two exact range
   joins at the largest eps (:func:`canopy.operators.cluster.links`);
2. DBSCAN* components per level;
3. the tree: every cluster at level ``l`` lies inside exactly one cluster
   at level ``l+1`` (edges and core sets only grow with eps), found by a
   join between adjacent levels;
4. condensing, stability and the bottom-up / top-down selection passes are
   one small join per level over per-cluster tables (one row per cluster,
   never per point);
5. each point takes the selected cluster that contains it, else -1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.operators import cluster as C
from canopy.operators.components import connected_components
from canopy.operators.util import materialize

OUTLIER = -1


def levels(eps_min: float, eps_max: float, n: int) -> list[float]:
    """Geometric grid of ``n`` eps values from ``eps_min`` to ``eps_max``."""
    if n == 1:
        return [eps_max]
    r = (eps_max / eps_min) ** (1.0 / (n - 1))
    return [eps_min * r ** i for i in range(n)]


def hdbscan(points: DataFrame, eps_levels: Sequence[float], min_pts: int, min_cluster_size: int, dim: int,
            key: str = "id", vec: str = "vec") -> DataFrame:
    """(key, cluster) with cluster = ``level_component`` id of the selected
    condensed cluster, or NULL for noise."""
    eps = sorted(eps_levels)
    top = len(eps) - 1
    lam = [1.0 / e for e in eps]

    # 1. who is core, and down to which level, from the nearest neighbours alone
    dist = materialize(C.core_points(points, eps[-1], min_pts, dim, key, vec), "hdb_core_dist")
    cored = points.select(key).join(dist, key)
    core = materialize(cored.select(key, F.explode(F.array_compact(F.array(*[
        F.when(F.coalesce("core_dist", F.lit(0.0)) <= e, F.lit(li)) for li, e in enumerate(eps)]))).alias("level")), "hdb_core")
    # 2. components of every level in ONE connected-components run: the node key
    #    is the pair (level, id), so labels never cross levels
    le = C.links(points, dist, eps, dim, key, vec)

    def node(c: str):
        return F.struct(F.col("level").cast("int").alias("level"), F.col(c).alias("id"))

    comp = connected_components(core.select(node(key).alias("id")),
                                le.select(node("src").alias("src"), node("dst").alias("dst")), "id")
    lab = comp.select("id.level", F.col("id.id").alias(key), F.col("component.id").alias("comp"))
    size = lab.groupBy("level", "comp").agg(F.count(F.lit(1)).alias("_n"))
    members = materialize(lab.join(size.where(F.col("_n") >= min_cluster_size), ["level", "comp"])
                          .select("level", key, "comp", "_n"), "hdb_members")

    # 3. per-cluster table with its parent at the next level
    clusters = members.groupBy("level", "comp").agg(F.first("_n").alias("size"), F.min(key).alias("_any"))
    up = members.select((F.col("level") - 1).alias("level"), key, F.col("comp").alias("parent"))
    with_parent = (clusters.join(up.withColumnRenamed(key, "_any"), ["level", "_any"], "left")
                   .select("level", "comp", "size", "parent"))
    nchild = with_parent.where(F.col("parent").isNotNull()).groupBy(
        (F.col("level") + 1).alias("plevel"), F.col("parent").alias("pcomp")).agg(F.count(F.lit(1)).alias("_nc"))
    tree = materialize(with_parent.join(
        nchild, (with_parent.level == nchild.plevel) & (with_parent.comp == nchild.pcomp), "left")
        .select("level", "comp", "size", "parent", F.coalesce("_nc", F.lit(0)).alias("n_children")), "hdb_tree")

    # 4a. condensed ids, top-down: a single child keeps its parent's id
    kid = {top: tree.where(F.col("level") == top).select(
        "level", "comp", F.concat_ws("_", F.col("level").cast("string"), F.col("comp").cast("string")).alias("K"))}
    parent_nc = tree.select(F.col("level").alias("_pl"), F.col("comp").alias("_pc"), F.col("n_children").alias("_pn"))
    for li in range(top - 1, -1, -1):
        cur = tree.where(F.col("level") == li)
        above = kid[li + 1].select(F.col("comp").alias("parent"), F.col("K").alias("_pk"))
        j = (cur.join(above, "parent", "left")
             .join(parent_nc.where(F.col("_pl") == li + 1), F.col("parent") == F.col("_pc"), "left"))
        own = F.concat_ws("_", F.lit(str(li)), F.col("comp").cast("string"))
        kid[li] = j.select("level", "comp", F.when(F.col("_pn") == 1, F.col("_pk")).otherwise(own).alias("K"))
    cond = kid[0]
    for li in range(1, top + 1):
        cond = cond.unionByName(kid[li])
    cond = materialize(cond.join(tree, ["level", "comp"]), "hdb_cond")

    # 4b. stability: sum over the levels a condensed cluster lives of size * d(lambda)
    dl = F.lit(0.0)
    for li in range(len(eps)):
        step = (lam[li - 1] - lam[li]) if li > 0 else 0.0
        dl = F.when(F.col("level") == li, F.lit(step)).otherwise(dl)
    stab = cond.groupBy("K").agg(F.sum(F.col("size") * dl).alias("S"), F.min("level").alias("_lo"),
                                 F.max("level").alias("birth"))
    # condensed parent of K: the condensed id of the parent of K's birth cluster
    birth = cond.join(stab.select("K", "birth"), "K").where(F.col("level") == F.col("birth"))
    kmap = cond.select(F.col("level").alias("_l"), F.col("comp").alias("_c"), F.col("K").alias("KP"))
    kp = (birth.join(kmap, (F.col("_l") == F.col("level") + 1) & (F.col("_c") == F.col("parent")), "left")
          .select("K", "KP", "birth"))
    ktab = materialize(stab.join(kp, ["K", "birth"]), "hdb_ktab")

    # 4c. bottom-up: best(K) = max(S(K), sum best(children)); selected when S(K) wins
    done = []
    for li in range(0, top + 1):
        cur = ktab.where(F.col("birth") == li)
        if done:
            below = done[0]
            for d in done[1:]:
                below = below.unionByName(d)
            kids = below.groupBy(F.col("KP").alias("K")).agg(F.sum("best").alias("_kids"))
            cur = cur.join(kids, "K", "left")
        else:
            cur = cur.withColumn("_kids", F.lit(None).cast("double"))
        kids_sum = F.coalesce("_kids", F.lit(0.0))
        has_kids = F.col("_kids").isNotNull()
        sel = ~has_kids | (F.col("S") >= kids_sum)
        cur = cur.select("K", "KP", "birth", sel.alias("sel"),
                         F.when(sel, F.col("S")).otherwise(kids_sum).alias("best"))
        done.append(materialize(cur, "hdb_best"))
    best = done[0]
    for d in done[1:]:
        best = best.unionByName(d)

    # 4d. top-down: keep a selected cluster only when no ancestor is selected
    final = None
    taken = None
    for li in range(top, -1, -1):
        cur = best.where(F.col("birth") == li)
        if taken is not None:
            cur = cur.join(taken.select(F.col("K").alias("KP"), F.col("_blocked")), "KP", "left")
        else:
            cur = cur.withColumn("_blocked", F.lit(False))
        blocked = F.coalesce("_blocked", F.lit(False))
        cur = materialize(cur.select("K", (blocked | F.col("sel")).alias("_blocked"),
                                     (~blocked & F.col("sel")).alias("chosen")), "hdb_sel")
        taken = cur if taken is None else taken.unionByName(cur)
        final = cur if final is None else final.unionByName(cur)
    chosen = final.where("chosen").select("K")

    # 5. labels: the chosen condensed cluster containing the point
    pk = members.join(cond.select("level", "comp", "K"), ["level", "comp"]).join(chosen, "K")
    lab = pk.groupBy(key).agg(F.min("K").alias("cluster"))
    return points.select(key).join(lab, key, "left")


def hdbscan_topics(points: DataFrame, eps_levels: Sequence[float], min_pts: int, min_cluster_size: int,
                   dim: int, key: str = "id") -> DataFrame:
    """(key, topic): selected clusters renumbered by size, -1 for noise."""
    from canopy.operators import topics as TP
    lab = hdbscan(points, eps_levels, min_pts, min_cluster_size, dim, key)
    a = lab.select(key, F.coalesce("cluster", F.lit(str(OUTLIER))).alias("topic"))
    return TP.renumber(a, key)
