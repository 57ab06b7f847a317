"""Numeric column expressions (rows 28-33): non-finite handling, clipping, floors.

Scalar and array forms; arrays use ``transform``/``forall`` so a feature block
stays one column and never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

INF = float("inf")


def ieee_ratio(num: str | Column, den: str | Column) -> Column:
    """n / d with IEEE results for d = 0 (±inf, NaN for 0/0).  Spark itself
    returns null or fails there, so the non-finite values are spelled out."""
    n, d = col_of(num).cast("double"), col_of(den).cast("double")
    return (F.when(d != 0, n / d)
            .when(n == 0, F.lit(float("nan")))
            .otherwise(F.signum(n) * F.lit(INF)))


def is_finite(c: str | Column) -> Column:
    x = col_of(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(INF))


def zero_nonfinite(c: str | Column) -> Column:
    x = col_of(c)
    return F.when(is_finite(x), x).otherwise(F.lit(0.0))


def zero_nonfinite_array(arr: str | Column) -> Column:
    return F.transform(col_of(arr), lambda x: F.when(is_finite(x), x).otherwise(F.lit(0.0)))


def all_finite(arr: str | Column) -> Column:
    return F.forall(col_of(arr), lambda x: is_finite(x))


def clip_array(arr: str | Column, lo: float = -10.0, hi: float = 10.0) -> Column:
    return F.transform(col_of(arr), lambda x: F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def price_floor(pred: str | Column, floor: float = 0.01) -> Column:
    return F.greatest(col_of(pred).cast("double"), F.lit(floor))
