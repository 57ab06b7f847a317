"""Image acquisition planning (rows 42, 57, 97, 98).

Downloading is network I/O and is not done here; what is built is the plan
around it: which links still need a file, which failed, and the counts.  All
steps are joins and aggregates keyed by file name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.links import url_filename


def with_filename(links: DataFrame, url_col: str = "image_link") -> DataFrame:
    return links.withColumn("filename", url_filename(url_col))


def worklist(links: DataFrame, manifest: DataFrame, url_col: str = "image_link") -> DataFrame:
    """Links whose file is not stored yet, one per file name (smallest link).

    ``manifest`` holds ``filename`` of stored files.  Left-anti join on the
    file name, then a per-file aggregate: both shuffle by file name once (the
    aggregate reuses the join's partitioning).
    """
    todo = with_filename(links.select(url_col).na.drop(), url_col).join(
        manifest.select("filename").distinct(), "filename", "left_anti")
    return todo.groupBy("filename").agg(F.min(url_col).alias(url_col))


def limit_links(links: DataFrame, n: int, order_col: str) -> DataFrame:
    """First ``n`` links in an explicit order (Spark rows have none)."""
    return links.orderBy(order_col).limit(n)


def fetch_status(links: DataFrame, manifest: DataFrame, url_col: str = "image_link") -> DataFrame:
    """Every link with ``status`` = fetched / missing (missing = retry list)."""
    stored = manifest.select("filename").distinct().withColumn("_stored", F.lit(True))
    return (with_filename(links.select(url_col).na.drop(), url_col)
            .join(stored, "filename", "left")
            .select(url_col, "filename",
                    F.when(F.col("_stored"), "fetched").otherwise("missing").alias("status")))


def link_counts(links: DataFrame, manifest: DataFrame, url_col: str = "image_link") -> DataFrame:
    """usable / null / already fetched / left to retry.  Links are counted by
    file name before the join (null ones too, which match nothing), so a hot
    link is one row of it."""
    stored = manifest.select("filename").distinct().withColumn("_stored", F.lit(1))
    counted = with_filename(links.select(url_col), url_col).groupBy("filename").agg(
        F.count(url_col).alias("usable"), F.sum(F.col(url_col).isNull().cast("long")).alias("null_links"))
    j = counted.join(stored, "filename", "left")
    return j.agg(
        F.coalesce(F.sum("usable"), F.lit(0)).alias("usable"),
        F.sum("null_links").alias("null_links"),
        F.sum(F.when(F.col("_stored").isNotNull(), F.col("usable")).otherwise(0)).alias("fetched"),
        F.sum(F.when(F.col("_stored").isNull(), F.col("usable")).otherwise(0)).alias("to_retry"),
    )
