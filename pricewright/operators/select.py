"""Schema-driven column roles (rows 11-13, 26-28).

Roles are resolved from ``df.schema`` on the driver (no data scan), except the
text-priority rule, which needs one aggregate row of mean lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fill_empty

# Candidate text columns in priority order.
TEXT_PRIORITY = ["title", "name", "description", "text", "product_description"]

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def string_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def concat_text(df: DataFrame, exclude: tuple[str, ...] = ("sample_id",)):
    """All string columns, null → "", joined by one space; none → ""."""
    return joined_text(string_columns(df, exclude))


def text_columns(df: DataFrame, exclude: tuple[str, ...] = ("sample_id",)) -> list[str]:
    """The columns that ``select_text_priority`` takes: the first priority column
    present whose mean length is > 0, else all string columns.

    One aggregate over all candidates at once (a single job, one row back).
    """
    present = [c for c in TEXT_PRIORITY if c in df.columns]
    if present:
        row = df.agg(*[F.avg(F.length(F.col(c))).alias(c) for c in present]).first()
        for c in present:
            if row[c] is not None and row[c] > 0:
                return [c]
    return string_columns(df, exclude)


def joined_text(cols: list[str]):
    """The texts of the columns, null → "", joined by one space; none → ""."""
    return F.concat_ws(" ", *[fill_empty(c) for c in cols]) if cols else F.lit("")


def select_text_priority(df: DataFrame, exclude: tuple[str, ...] = ("sample_id",)):
    """First priority column present whose mean length is > 0, else ``concat_text``."""
    return joined_text(text_columns(df, exclude))


def select_text_catalog(df: DataFrame, exclude: tuple[str, ...] = ("sample_id",)):
    if "catalog_content" in df.columns:
        return fill_empty("catalog_content")
    return concat_text(df, exclude)


def common_numeric(train: DataFrame, test: DataFrame, exclude: tuple[str, ...] = ("price", "sample_id")) -> list[str]:
    """Numeric columns in both tables, minus ``exclude``, in train order."""
    test_num = set(numeric_columns(test))
    return [c for c in numeric_columns(train, exclude) if c in test_num]


def feature_columns(df: DataFrame, id_col: str = "sample_id") -> list[str]:
    """Numeric columns except the id; if there are none, columns named ``f_*``."""
    cols = numeric_columns(df, (id_col,))
    return cols or [c for c in df.columns if c.startswith("f_")]


def fill_numeric_nulls(df: DataFrame, cols: list[str], value: float = 0.0) -> DataFrame:
    return df.na.fill(value, subset=cols)


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; available: {df.columns}")
    return df


def array_width(df: DataFrame, col: str) -> int:
    """Length of the longest array of a column (one tiny aggregate; 0 without any)."""
    return int(df.agg(F.max(F.size(col))).first()[0] or 0)
