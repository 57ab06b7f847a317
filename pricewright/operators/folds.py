"""Balanced folds (row 77): the rows in order of a seeded hash of their id, dealt
out in turn, so that fold sizes differ by one at most.

The rank is exact and distributed: ids are range-partitioned by (hash, id), a
row's rank is its number in its partition plus the rows of the partitions
before, and only one count a partition reaches the driver.  Neither the result
nor the balance depends on the partitioning.  Rows that share an id are dealt out
one after the other in ``ranked``; ``with_folds`` gives them the id's first fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import md5_bits32, salted
from ..session import cut_lineage


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """The rows with their rank (0, 1, 2 ...) in the given order."""
    placed = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = sorted(placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row a partition
    first, at = [], 0
    for r in sizes:
        first.append((r["_part"], at))
        at += r["n"]
    start = rows.sparkSession.createDataFrame(first or [(0, 0)], "_part long, _first long")
    return (placed.withColumn("_part", part).join(F.broadcast(start), "_part")
            .withColumn(name, F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_first"))


def fold_table(df: DataFrame, k: int = 5, seed: int = 42, id_col: str = "sample_id", name: str = "cv_fold") -> DataFrame:
    """(id, fold) for every distinct id."""
    ids = df.select(id_col).distinct().withColumn("_h", md5_bits32(salted(F.col(id_col), seed)))
    out = ranked(ids, [F.asc("_h"), F.asc(id_col)], "_rank")
    return out.select(id_col, (F.col("_rank") % k).cast("int").alias(name))


def with_folds(df: DataFrame, k: int = 5, seed: int = 42, id_col: str = "sample_id", name: str = "cv_fold") -> DataFrame:
    """The rows with their fold."""
    return df.join(fold_table(df, k, seed, id_col, name), id_col)
