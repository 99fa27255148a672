"""Connected components by alternating large-star and small-star, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node gives its larger neighbours its least neighbour (or itself)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("u", "_m").alias("m"))
    # written before the join, which adaptive execution can then split at a node with very many edges
    least = materialise(least, "cc-least")
    return both.where("v > u").join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node gives its smaller neighbours, and itself, the least of them. Edges point to the smaller end."""
    least = materialise(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), "m"), "cc-least")
    moved = edges.join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("_u").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()


def _stars_only(edges: DataFrame) -> bool:
    """Whether every edge leads from a leaf of one edge to a centre that is no leaf."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre"))
    ends = ends.union(edges.select(F.col("v"), F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("leaf").alias("leaves"), F.max("centre").alias("centre"))
    return nodes.where("leaves > 1 or (leaves = 1 and centre = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``u, v`` pairs of longs in; ``node, component`` out, the component being its least node.

    Nodes without an edge do not appear; repeated edges and edges from a node to itself do no harm; an empty
    table gives an empty table; edges with a null end are left out. A node with very many edges is a key of
    partial aggregates and of joins that adaptive execution splits, never of a window or a collected group.
    Every round is a written table, so a lost executor costs no more than the round; older ones are deleted.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialise(edges, "cc-edges")
    for _ in range(MAX_ROUNDS):
        if _stars_only(edges):
            break
        large = materialise(_large_star(edges), "cc-large")
        discard(edges)
        edges = materialise(_small_star(large), "cc-small")
        discard(large)
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
