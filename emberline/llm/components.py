"""Connected components of an undirected graph in DataFrames, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.functions.storage import discard, materialize

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above u is hung on the smallest node around u."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point down (u > v): u and all its lower neighbours are hung on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node of its component.

    Nodes are hung on ever smaller ones until every edge leads from a node to its root. No neighbour list is
    ever collected; each round is written to the shared folder, so that lineage stays short. The number of
    rounds grows with the logarithm of the size of a component.
    """
    down = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, seen = materialize(down, "edges"), None
    for _ in range(MAX_ROUNDS):
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("s")).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = state
        after = materialize(_small_star(_large_star(now)), "edges")
        discard(now)
        now = after
    raise RuntimeError("components did not settle")
