"""Connected components of a graph given as pairs, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samedays.llm.common import Scratch


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every neighbour greater than a node is tied to the least of the node and its neighbours."""
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of those."""
    least = pairs.groupBy("a").agg(F.min("b").alias("low"))
    tied = pairs.join(least, "a").filter(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return tied.union(least.select("a", F.col("low").alias("b"))).distinct()


def connected_components(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of the pairs (a, b) with a > b, other than the roots themselves.

    The root is the least node of the component. Each round halves the distance to the root at least, so rounds
    grow with the logarithm of the longest chain. Hot nodes are never gathered: least neighbours are partial
    aggregates, and the joins are plain, so that Spark splits skewed keys. A round's table is dropped after the next.
    """

    def state(frame: DataFrame) -> tuple:
        row = frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    current = scratch.keep(pairs.select("a", "b").distinct())
    before, held = state(current), scratch.count
    while before[0]:
        current = scratch.keep(_small_star(_large_star(current)))
        after = state(current)
        scratch.drop(held)
        held = scratch.count
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
