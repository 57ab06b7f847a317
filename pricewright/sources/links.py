"""Image-link work lists (rows 9-10, 34)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import col_of


def url_source(df: DataFrame, column: str) -> DataFrame:
    """Non-null links of one column, as strings."""
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found; available: {df.columns}")
    return df.select(F.col(column).cast("string").alias("image_link")).na.drop()


def faillog_source(spark: SparkSession, path: str) -> DataFrame:
    """One link per line; lines trimmed, blank lines dropped."""
    lines = spark.read.text(path).select(F.trim(F.col("value")).alias("image_link"))
    return lines.filter(F.col("image_link") != "")


def url_filename(url: str | Column) -> Column:
    """Last path component of the link (trailing slashes ignored)."""
    return F.regexp_extract(col_of(url), r"([^/]+)/*$", 1)
