"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.shared import stored


def _smallest(pairs: DataFrame) -> DataFrame:
    """Per left node the smallest node among itself and its right nodes. Partial
    sums come first, so a node of very many edges is no burden."""
    return pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; ``root`` is the smallest
    node that can be reached.

    Alternates large-star and small-star steps until nothing changes, which takes
    few rounds also for long chains. The minima are written before they are joined,
    so that both sides of the join are plain exchanges, which adaptive execution
    splits where a node has very many edges.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    mark = None
    if now.isEmpty():
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(rounds):
        both = now.union(now.select("b", "a"))
        large = both.join(stored(_smallest(both)), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct())
        small = large.join(stored(_smallest(large)), "a")
        step = small.select(F.col("a"), F.col("m").alias("b")).union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = stored(step.where("a <> b").distinct())
        # A fixed point is a set of stars. Counts and sums of hashes tell it from any other set of edges.
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())
