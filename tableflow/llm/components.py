"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.session import pinned

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); root is the least node of its component.

    Each round joins edges with the least neighbour of a node, a sum that combines before its shuffle, and is written,
    so lineage stays short. It ends when a round changes nothing.
    """
    e = pinned(_ordered(edges), "component_edges")
    seen = None
    for _ in range(MOST_ROUNDS):
        e = pinned(_small(_large(e)), "component_edges")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
    raise RuntimeError("components did not settle")


def _ordered(edges: DataFrame) -> DataFrame:
    """Edges with a > b, each once."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets the node's least neighbour."""
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours get the least of them."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    rest = e.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
