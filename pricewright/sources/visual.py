"""Precomputed per-item visual vectors (row 4).

Input is any table with an id column and either one array column or several
numeric columns (``f_*`` as the fallback).  Output: ``(sample_id STRING,
features ARRAY<FLOAT>)`` with one row per id; when an id repeats, the last
record in file order wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.select import feature_columns


def visual_features(df: DataFrame, id_col: str = "sample_id", vec_col: str | None = None,
                    order_col: str | None = None) -> DataFrame:
    """``order_col`` orders duplicates explicitly; by default the order is the
    file order of a file-based scan (``_metadata``)."""
    if vec_col is None:
        arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
        vec_col = arrays[0] if arrays else None
    if vec_col is not None:
        vec = F.col(vec_col).cast("array<float>")
    else:
        cols = feature_columns(df, id_col)
        vec = F.array(*[F.col(c).cast("float") for c in cols])
    # file order = (file path, row index within file); both come from the scan
    order = (F.col(order_col) if order_col is not None
             else F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    rows = df.select(F.col(id_col).cast("string").alias("sample_id"), vec.alias("features"), order.alias("_ord"))
    # partial aggregation keeps a hot duplicated id to one record per map task
    return rows.groupBy("sample_id").agg(F.max_by("features", "_ord").alias("features"))
