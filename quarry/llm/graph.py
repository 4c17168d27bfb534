"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is two joins and two aggregations over the edges; nothing is collected but one
checksum per round.  Rounds are cut by reliable checkpoints.  A hub's minimum is taken by a
partial aggregate and its edges are joined back by a join that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest one."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.where("a <> b").union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge; ``root`` is its component's smallest node."""
    ensure_checkpoint_dir(edges.sparkSession)
    now = (
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where("a <> b")
        .distinct()
        .checkpoint()
    )
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if seen == state:
            break
        seen = state
        now = _small_star(_large_star(now)).checkpoint()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
