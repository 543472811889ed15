"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for each node of ``edges`` (a, b); the component is its
    smallest node. Nothing but one number a round reaches the driver.

    A large-star step links every larger neighbour of a node to the smallest
    neighbour, a small-star step every smaller one; both keep what is connected
    connected. Done is when every node has one edge, to a node without one: then
    each component is a star around its smallest node. Each round is written to
    the shared folder."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("node"),
                                       F.least("a", "b").alias("to")).distinct()
    now = saved(now, "edges")
    while not _is_stars(now):
        both = now.union(now.select("to", "node"))
        least = both.groupBy("node").agg(F.least(F.min("to"), F.first("node")).alias("least"))
        large = both.join(least, "node").where("to > node").select(
            F.col("to").alias("node"), F.col("least").alias("to"))
        least = large.groupBy("node").agg(F.min("to").alias("least"))
        small = large.join(least, "node").where("to <> least").select(
            F.col("to").alias("node"), F.col("least").alias("to"))
        now = saved(small.union(least.select("node", "least")).distinct(), "edges")
    return now.select(F.col("node").alias("id"), F.col("to").alias("component")).union(
        now.select("to", "to").distinct())


def _is_stars(edges: DataFrame) -> bool:
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = edges.select(F.col("node").alias("id"), one.alias("edges"), none.alias("ends")).union(
        edges.select("to", none, one))
    per_node = ends.groupBy("id").agg(F.sum("edges").alias("edges"), F.max("ends").alias("ends"))
    return per_node.agg(F.max(F.col("edges") + F.when(
        F.col("edges") > 0, F.col("ends")).otherwise(0))).first()[0] in (None, 0, 1)
