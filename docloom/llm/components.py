"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import checkpoint


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least of its neighbours and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of these; a > b in ``edges``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) of every node in ``edges`` (a long, b long): label is the least node reachable.

    Each round is checkpointed; a round costs four aggregations or joins of the
    remaining edges, and the number of rounds grows with the logarithm of the
    longest path. Loops and repeated edges are ignored.
    """
    now = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(rounds):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
        now = checkpoint(_small(_large(now)))
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
