"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelabel.llm.common import small_enough, stored


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours move to the smallest of them: the larger ones, or the smaller ones."""
    pairs = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        pairs = pairs.unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    if large:
        # A node may have very many neighbours: with shuffles of its own the join can split them.
        least = stored(least)
    joined = pairs.join(F.broadcast(least) if large and small_enough(least) else least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of (a, b) links; the component is its smallest node.

    Each round moves links towards the smallest neighbour until nothing changes, which is when
    every node hangs on its component's smallest one. The rounds grow with the logarithm of the
    longest path. Links are stored after each round; the driver sees one checksum per round.
    """
    ordered = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, mark = stored(ordered.distinct()), None
    while True:
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == mark or not found[0]:
            break
        mark = tuple(found)
        now = stored(_stars(_stars(now, large=True), large=False))
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
