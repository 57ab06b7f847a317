"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, free_shuffles


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _hooked(neighbours: DataFrame, keep) -> DataFrame:
    """Links every neighbour that ``keep`` names to the least of a node's
    neighbourhood.  The least is found by a pre-aggregated grouping; a hub's
    rows are joined, never gathered."""
    least = neighbours.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return neighbours.join(least, "a").filter(keep).select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the least
    node that can be reached.  Alternates large and small stars until the links
    no longer change; each round's links are checkpointed."""
    links = cut_lineage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        large = _hooked(_both_ways(links), F.col("b") > F.col("a")).filter("a <> b").distinct()
        # small star: a node's smaller neighbours, and the node itself, go to the least of them
        small = _hooked(large, F.lit(True)).union(large.groupBy("a").agg(F.min("b").alias("b")))
        links = cut_lineage(small.filter("a <> b").distinct())
        del large, small
        free_shuffles(links.sparkSession)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == now:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        seen = now
