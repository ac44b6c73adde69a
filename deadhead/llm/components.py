"""Connected components of a large graph by alternating stars: each round is two grouped minima, written as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deadhead.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour is joined to the smallest of the neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are joined to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node with an edge (u, v): root is the smallest node that it is connected with.

    Rounds end when every edge leads from a node to a root; their number grows with the logarithm of the longest path.
    """
    kept = edges.filter("u <> v").distinct()
    before = None
    while True:
        kept = materialize(_small_star(_large_star(kept)).distinct(), name)
        state = kept.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = kept.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
