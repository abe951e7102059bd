"""Connected components by alternating star contraction, one written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialize


def _print(edges: DataFrame) -> tuple:
    """Count and order-free digest of distinct edges."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges`` (a, b).

    Large-star and small-star steps halve long paths, so rounds grow with the logarithm
    of the longest path. Each round is written to shared storage; groups are aggregated
    before they are shuffled, and a node's neighbours are never gathered in one row.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    print_now = _print(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        # Large star: every larger neighbour of a node is hung below the node's smallest one.
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        large = materialize(large, "large-star")
        # Small star: a node's smaller neighbours are hung below the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        after = materialize(small.union(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct(), "small-star")
        # A forest of stars does not change any more.
        print_after = _print(after)
        unchanged = print_after == print_now
        now, print_now = after, print_after
        if unchanged:
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
