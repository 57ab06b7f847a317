"""Scalers fitted on one table and applied to any (rows 31, 65-66, 69-70).

``fit`` runs one aggregate job and returns the statistics (a handful of numbers
per column: the fitted model); ``transform`` is then pure column expressions.
Array-valued blocks are scaled element-wise with ``zip_with`` so a feature
block remains one column.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles


@dataclass
class ColumnScaler:
    """(x − center) / scale per named column."""

    center: dict[str, float]
    scale: dict[str, float]

    def column(self, c: str) -> Column:
        return (F.col(c).cast("double") - F.lit(self.center[c])) / F.lit(self.scale[c])

    def transform(self, df: DataFrame, cols: list[str] | None = None) -> DataFrame:
        cols = cols or list(self.center)
        return df.withColumns({c: self.column(c) for c in cols})


def _safe(s: float | None) -> float:
    """Zero (or undefined) spread → 1, as the reference's scalers do."""
    return 1.0 if s is None or s == 0.0 else float(s)


def fit_standard(df: DataFrame, cols: list[str]) -> ColumnScaler:
    """Mean and population standard deviation."""
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    return ColumnScaler({c: float(row[f"m_{i}"] or 0.0) for i, c in enumerate(cols)},
                        {c: _safe(row[f"s_{i}"]) for i, c in enumerate(cols)})


def fit_robust(df: DataFrame, cols: list[str]) -> ColumnScaler:
    """Median and inter-quartile range (linear interpolation between ranks)."""
    center, scale = {}, {}
    for c, q in zip(cols, exact_quantiles(df, cols, [0.25, 0.5, 0.75])):
        q1, med, q3 = q or (0.0, 0.0, 0.0)
        center[c] = float(med)
        scale[c] = _safe(q3 - q1)
    return ColumnScaler(center, scale)


@dataclass
class ArrayScaler:
    """Element-wise (x − mean) / std for an ``array<double|float>`` column."""

    mean: list[float]
    std: list[float]

    def column(self, c: str | Column) -> Column:
        x = F.col(c) if isinstance(c, str) else c
        m = F.array(*[F.lit(v) for v in self.mean])
        s = F.array(*[F.lit(v) for v in self.std])
        return F.zip_with(F.zip_with(x, m, lambda a, b: a.cast("double") - b), s, lambda a, b: a / b)


def fit_standard_array(df: DataFrame, c: str, dim: int) -> ArrayScaler:
    """Per-element mean and population std from one aggregate of vectors."""
    stats = Summarizer.metrics("mean", "std", "count")
    r = df.select(stats.summary(array_to_vector(F.col(c).cast("array<double>"))).alias("s")).first()["s"]
    if not r["count"]:
        return ArrayScaler([0.0] * dim, [1.0] * dim)
    whole = math.sqrt((r["count"] - 1) / r["count"])  # Summarizer divides by n - 1
    return ArrayScaler([float(v) for v in r["mean"]], [_safe(float(v) * whole) for v in r["std"]])
