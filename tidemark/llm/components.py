"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch


def _settle(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One star step: neighbours of a node move on to the least node around it."""
    if both_ways:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = around.join(least, "u")
    if both_ways:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, least) for the nodes of the undirected edges (u, v) that are not themselves the least of
    their component. Nodes may be of any type that has an order.

    Alternating large-star and small-star steps: each only groups and joins by node, and after
    logarithmically many the edges are stars around the least node of each component. Every round is
    written to `scratch`, so a lost executor costs that round at most.
    """
    high, low = F.greatest("u", "v"), F.least("u", "v")
    edges = scratch.staged(edges.where("u <> v").select(high.alias("u"), low.alias("v")).distinct(), "components")
    state = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("least"))
        state = seen
        edges = scratch.staged(_settle(scratch.staged(_settle(edges, True), "components"), False), "components")
