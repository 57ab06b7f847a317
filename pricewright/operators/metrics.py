"""Error metrics and summary aggregates (rows 45-53).

All are aggregate ``Column`` expressions, so they run as partial + final hash
aggregation (map-side combine) inside any ``groupBy`` or global ``agg``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col_of


def smape(pred: str | Column, actual: str | Column) -> Column:
    """100·mean(2|p−y| / (|y|+|p|)); a 0/0 row adds 0 and still counts in n."""
    p, y = col_of(pred), col_of(actual)
    d = F.abs(y) + F.abs(p)
    return F.lit(100.0) * F.avg(F.when(d == 0, F.lit(0.0)).otherwise(F.lit(2.0) * F.abs(p - y) / d))


def smape_drop_zero(pred: str | Column, actual: str | Column) -> Column:
    """Variant: 0/0 rows are removed; half-sum floored at 1e-8; nothing left → 0."""
    p, y = col_of(pred), col_of(actual)
    keep = (y != 0) | (p != 0)
    half = F.greatest((F.abs(y) + F.abs(p)) / 2.0, F.lit(1e-8))
    return F.coalesce(F.lit(100.0) * F.avg(F.when(keep, F.abs(y - p) / half)), F.lit(0.0))


def mae(pred: str | Column, actual: str | Column) -> Column:
    return F.avg(F.abs(col_of(pred) - col_of(actual)))


def smape_by_group(df: DataFrame, pred: str, actual: str, group: str = "fold") -> DataFrame:
    """Per-group SMAPE plus the mean of the group scores (one row per group).

    The per-group aggregate is a partial+final hash aggregation over the data;
    the mean over groups is a window over the per-group result, whose size is
    the number of folds (k rows), not the data.
    """
    per = df.groupBy(group).agg(smape(pred, actual).alias("smape"), F.count(F.lit(1)).alias("n"))
    return per.withColumn("mean_smape", F.avg("smape").over(Window.partitionBy()))


def target_stats(df: DataFrame, label: str = "price") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(label).alias("mean"),
        F.stddev_pop(label).alias("std_pop"),
    )


def prediction_summary(df: DataFrame, pred: str = "price") -> DataFrame:
    return df.agg(
        F.min(pred).alias("min"),
        F.max(pred).alias("max"),
        F.avg(pred).alias("mean"),
        F.stddev_pop(pred).alias("std"),
    )
