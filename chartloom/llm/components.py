"""Connected components of a graph given as a table of edges.

Large-star and small-star steps in turn: every node hands its neighbours on to the smallest
one it knows. Each step is one ``min`` by node, added up in every task first, and joined to the
edges: by broadcast for the nodes with very many neighbours, by hash for the others, so no task
gets all edges of such a node. Rounds end when every edge leads to the least node of its component,
which one exact count by node shows, after about the square of the logarithm of the longest
path. A step's edges are deleted once the next ones are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import BROADCAST_ROWS, stage_for_now

MANY_NEIGHBOURS = 1_000


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(neighbours: DataFrame, larger: bool, many: int) -> DataFrame:
    """Link neighbours (the larger ones, or the smaller ones and the node) to the least of all."""
    least = neighbours.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("n"))
    # At most (rows / many) nodes, which the caller's ``many`` keeps below BROADCAST_ROWS.
    crowded = F.broadcast(least.where(F.col("n") >= many).select("a", "m"))
    others = neighbours.join(crowded.select("a"), "a", "left_anti").join(least.where(F.col("n") < many).drop("n"), "a")
    joined = others.unionByName(neighbours.join(crowded, "a"))
    if larger:
        linked = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return linked.where("a > b").distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has only that one, which has no smaller one itself."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )).alias("end")).select("end.*")
    by_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return by_node.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; a component is named by its least node.

    ``edges`` has (a, b) of an orderable type; loops and nulls are left out.
    """
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, discard = stage_for_now(current, "edges")
    while not _is_done(current):
        for larger in (True, False):
            neighbours = _both_ways(current) if larger else current
            many = max(MANY_NEIGHBOURS, -(-neighbours.count() // BROADCAST_ROWS))
            following, discard_next = stage_for_now(_star(neighbours, larger, many), "edges")
            discard()
            current, discard = following, discard_next
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(centres)
