"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm.corpus import settled

MAX_ROUNDS = 60


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each pair (a, b) with `m`, the least of a and everything paired with it.

    The minimum is combined before the shuffle. It is settled before it is joined, since AQE splits a join
    where one `a` has very many pairs only if both sides come straight from their shuffles.
    """
    least = settled(pairs.groupBy("a").agg(F.least("a", F.min("b")).alias("m")))
    return pairs.join(least, "a")


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    moved = _with_least(both).filter("b > a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    marked = _with_least(down)
    ends = F.explode(F.array("b", "a")).alias("a")
    return marked.select(ends, F.col("m").alias("b")).filter("a <> b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """`node` and `root`, the least node it is connected with, for every node that is not its own root.

    `edges` has columns a and b of one ordered type, without nulls; loops and repeated edges do no harm, and an
    empty table gives none. The number of rounds grows with the logarithm of the longest path.
    """
    edges = settled(edges.filter("a <> b").distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        edges = settled(small_star(large_star(edges)))
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
