"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, drop, store


def _stars(edges: DataFrame, large: bool, few: bool) -> DataFrame:
    """One contraction: every node's neighbours (the larger ones, or the smaller ones and itself) go to its least."""
    both = edges if not large else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_least"))
    least = least.select(F.col("a").alias("_node"), F.least("a", "_least").alias("_least"))
    known = F.broadcast(least) if few else least
    if large:
        moved = both.where("b > a").join(known, F.col("a") == F.col("_node")).select(F.col("b").alias("a"), F.col("_least").alias("b"))
    else:
        moved = both.join(known, F.col("a") == F.col("_node")).select(F.col("b").alias("a"), F.col("_least").alias("b"))
        moved = moved.union(least.select(F.col("_node").alias("a"), F.col("_least").alias("b")))
    return moved.where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or is one, not both: the edges are stars."""
    ends = edges.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link.

    ``links`` has two bigint columns a and b; null ends and loops are ignored. Large-star
    and small-star steps alternate until all edges are stars, every round over a stored table
    of (node, smaller neighbour) pairs, so no group of links ever meets in one task.
    """
    edges = store(links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(rounds):
        if _settled(edges):
            break
        before, few = edges, edges.count() <= BROADCAST_ROWS // 2  # an edge has two nodes
        edges = store(_stars(_stars(edges, True, few), False, few), "links")
        drop(before)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
