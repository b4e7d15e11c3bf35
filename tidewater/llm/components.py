"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.tables import Workspace


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    near = _both_ways(edges)
    low = near.groupBy("a").agg(F.min("b").alias("low"))
    linked = near.where("b > a").join(low.withColumn("low", F.least("a", "low")), "a")
    return linked.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    linked = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = low.select("a", F.col("low").alias("b"))
    return linked.unionByName(own).where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one link, and that to a node that has none."""
    several = edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
    onward = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
    return several.unionAll(onward).isEmpty()


def connected_components(work: Workspace, edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the smallest node names it.

    Each round is written to the shared folder. The rounds grow with the logarithm of
    the longest path, and no node's neighbours are ever gathered in one place.
    """
    edges = work.write(edges.where("a <> b"), "edges")
    while not _settled(edges):
        after = work.write(_small_star(_large_star(edges)), "star")
        work.drop(edges)
        edges = after
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
