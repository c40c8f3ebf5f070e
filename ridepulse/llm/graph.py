"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from .common import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    return spread_join(both.filter("b > a"), least, ["a"], "inner").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; edges point from large to small."""
    least = edges.groupBy("a").agg(F.min("b").alias("_m"))
    moved = spread_join(edges, least, ["a"], "inner").filter("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return least.select("a", F.col("_m").alias("b")).unionByName(moved).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Node and root (smallest node of its component) for every node that an edge (a, b) touches.

    A hot node's edges are split in the joins and reduced before the shuffle in the minima. Each round is written to
    the shared folder. The number of rounds grows with the logarithm of the longest path; should the limit ever be
    too small, it raises. Self-loops and repeated edges change nothing; no edges give no rows.
    """
    now = store(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = None
    for _ in range(max_rounds):
        found = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if found == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state, now = found, store(_small_star(_large_star(now)), "edges")
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
