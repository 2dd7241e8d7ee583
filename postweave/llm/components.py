"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postweave.plans.storage import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every greater neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    joined = edges.join(least, "u")
    return joined.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v")).union(
        least.select("u", F.col("least").alias("v"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its least node.

    The number of rounds grows with the logarithm of the longest path, and no node gets all edges of its
    component but the least one, whose edges are joined, not gathered. Each round is a written table.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stored(edges, "edges")
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges).distinct()).where("u <> v").distinct(), "edges")
        # Equal sums over equal numbers of edges: nothing moved.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )
