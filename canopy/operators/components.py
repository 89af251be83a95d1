"""Connected components by alternating large-star and small-star steps.

Every edge always points from a node to a smaller one.  The large star links a
node's larger neighbours to the smallest node it sees, the small star links
its smaller neighbours to the smallest of them (Kiveris et al. 2014).  The
edge set shrinks to one star per component; the loop ends when a round leaves
it unchanged, so there is no limit on the rounds, which grow with the log of
the diameter.  Only an edge count and a check sum reach the driver, and the
table of a round is deleted once the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.operators.util import discard, materialize


def _downward(u: str, v: str, edges: DataFrame) -> DataFrame:
    return edges.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    # an edge (u, v) with u > v is the pair "v sees the larger neighbour u"
    return _downward("a", "b", edges.join(least, edges["v"] == least["c"]).select(F.col("u").alias("a"),
                                                                                 F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    seen = edges.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return _downward("a", "b", seen.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def star_forest(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(u, v): each node that has a smaller one in its component, and the smallest one there."""
    stars = materialize(_downward(src, dst, edges), "stars")
    state = _state(stars)
    while True:
        turned = materialize(_small_star(_large_star(stars)), "stars")
        discard(stars)
        stars, before = turned, state
        state = _state(stars)
        if state == before:
            return stars


def connected_components(nodes: DataFrame, edges: DataFrame, key: str = "id") -> DataFrame:
    """(key, component) with component = smallest key in the component.

    ``edges`` (src, dst) are taken as undirected; keys may be of any type that
    can be ordered.
    """
    stars = star_forest(edges)
    found = nodes.select(F.col(key).alias("u")).join(stars, "u", "left")
    return found.select(F.col("u").alias(key), F.coalesce("v", "u").alias("component"))
