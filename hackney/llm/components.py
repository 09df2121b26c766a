"""Connected components by alternating stars, all of it in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import stored


def _star(links: DataFrame, both_ways: bool) -> DataFrame:
    """Point the neighbours of each node, the larger or the smaller ones, to the smallest among them.

    The minimum is combined before the shuffle, and a hub's links are an ordinary skewed join,
    so no task holds all neighbours of a node.
    """
    if both_ways:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        found = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("root"))
        found = links.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        found = found.unionByName(least.select("a", F.col("root").alias("b")))
    return found.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links of integers to ``(node, root)``: the smallest node that each one reaches.

    Only nodes with a link to another appear. Stops when a round changes nothing; a round halves
    the depth of the trees at least. Every round is written, so the lineage stays short.
    """
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    pairs, state = stored(pairs, "links"), None
    while True:
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
        pairs = stored(_star(_star(pairs, both_ways=True), both_ways=False), "links")
