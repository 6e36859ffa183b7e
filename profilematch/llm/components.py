"""Connected components of links between numbers, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilematch.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's greater (large) or lesser (small) neighbours are linked to its least one, itself included.

    The least neighbour is an aggregate that combines before the shuffle, so a hub costs one row per task; its links
    meet that one row in a join that Spark can split.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.col("m").alias("v"))
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b); the root is the least node of its component."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        edges = stored(_star(stored(_star(edges, True), "star"), False), "star")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
