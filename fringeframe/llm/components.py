"""Connected components of a graph of any size, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, drop_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie the larger (or smaller) neighbours of every node to its least neighbour."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return both.where("v > u").join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))  # every edge has u > v
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links`` except the roots; the root is the least node.

    Each round is written to the shared folder; rounds end when nothing changes.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    seen = None
    while True:
        before, edges = edges, cut_lineage(_star(_star(edges, True), False))
        drop_table(before)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == tuple(now):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(now)
