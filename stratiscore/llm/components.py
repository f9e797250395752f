"""Connected components of a graph given as an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiscore.sources.staging import Workspace


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return (
        both.filter("b > a").join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to its smallest neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(workspace: Workspace, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node but the roots.

    Edges are rows (a, b) of one type. The number of rounds grows with the logarithm of the
    largest component; each round is staged, so a lost executor costs one round at most.
    """
    current = workspace.stage(edges.filter("a <> b").distinct(), "edges")
    before = None
    for step in range(max_rounds):
        current = workspace.stage(_large_star(current).distinct(), f"large-star-{step}")
        current = workspace.stage(_small_star(current).distinct(), f"small-star-{step}")
        after = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if after == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
    raise RuntimeError(f"the components have not settled in {max_rounds} rounds")
