"""Connected components of an undirected graph of long ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import stage


def _star(near: DataFrame, larger: bool) -> DataFrame:
    """Connect neighbours with the smallest of each node's neighbourhood (itself included)."""
    least = near.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
    joined = near.join(least, "u")
    if larger:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("least").alias("b"))
        out = out.unionByName(least.select(F.col("u").alias("a"), F.col("least").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on an edge; the component is its smallest node.

    ``edges`` has columns a and b. Loops, nulls and repeats don't matter. Each round is written to
    the shared folder; the number of rounds grows with the logarithm of a component's size. Only
    two sums visit the driver each round.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    pairs, before = stage(pairs, "edges"), None
    while True:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = stage(_star(both, larger=True), "large-star")
        small = _star(large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), larger=False)
        pairs = stage(small, "small-star")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
