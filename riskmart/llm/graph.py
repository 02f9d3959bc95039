"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are moved to the smallest of its neighbours and itself."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star")
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node and itself are moved to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stage(down.groupBy("a").agg(F.min("b").alias("m")), "star")
    moved = down.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b`` (any ordered type); the root is the smallest node.

    Each round is two joins on a node with the one row of its smallest neighbour; the table is written after
    it, so a lost executor costs a round at most. Rounds grow with the logarithm of the longest path.
    """
    now = stage(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct(), "edges")

    def state(table: DataFrame) -> tuple:
        return tuple(table.select(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before, seen = None, state(now)
    while seen != before:
        large = _large_star(now).filter(F.col("a") != F.col("b")).distinct()
        now = stage(_small_star(large).filter(F.col("a") != F.col("b")).distinct(), "edges")
        before, seen = seen, state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
