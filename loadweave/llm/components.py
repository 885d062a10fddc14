"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round replaces each edge by one to the smallest node seen, through a minimum by node and a join; both cope with a
node of many edges (partial sums, split joins). No group is gathered in one task and nothing is collected but two sums.
Each round is written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, settled


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v), u > v. Large: each node's larger neighbours move to its smallest one; small: its smaller neighbours and itself do."""
    near = _both_ways(edges) if large else edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("m", "u").alias("m"))
    joined = near.join(least, F.col("u") == F.col("w"))
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (u, v); root is the smallest node of its component. Edges of a node with itself do nothing.

    Rounds go on until one changes nothing, however many that takes (about the logarithm of the nodes, squared, at most)."""
    now = settled(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        # Sums of hashes: equal if and, but for a freak accident, only if the edges are.
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if sums == seen or not sums[0]:
            break
        seen = sums
        after = settled(_star(_star(now, large=True), large=False))
        discard(now)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
