"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its least node.

    Each round is a few shuffled aggregations of at most as many rows as there are links, written
    to the shared folder. A hub with many links is grouped by partial aggregation only.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # Large star: the larger neighbours of a node are linked to its least neighbour.
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: the smaller neighbours of a node and itself are linked to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        after = stored(small.where("a <> b").distinct(), "links")
        same = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if same == edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first():
            # Every node is linked to its component and to nothing else.
            return after.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        edges = after
    raise RuntimeError(f"components still change after {most_rounds} rounds")
