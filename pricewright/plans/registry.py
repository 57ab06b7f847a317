"""Named queries: one per SURVEY §2 row, each with its DuckDB oracle when SQL can
express it.  ``__spark_entry__.py`` exposes these two dicts to the driver."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import CATALOG_SQL

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def _positive_zero(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0::double)``: DuckDB keeps
    the sign of a value that rounds to zero (-0.0), Spark's decimal rounding
    does not; adding +0.0 maps -0.0 to 0.0 and changes nothing else."""
    out, i = [], 0
    for m in re.finditer(r"\bround\(", sql):
        if m.start() < i:
            continue
        depth, j = 0, m.end() - 1
        while j < len(sql):
            depth += {"(": 1, ")": -1}.get(sql[j], 0)
            if depth == 0:
                break
            j += 1
        inner = _positive_zero(sql[m.end():j])
        out.append(sql[i:m.start()] + f"(round({inner}) + 0.0::double)")
        i = j + 1
    return "".join(out) + sql[i:]


def register(key: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = _positive_zero(sql)
        return fn

    return deco


def with_catalog(*ctes: str, select: str) -> str:
    """``WITH catalog AS (...), <ctes> <select>`` for DuckDB."""
    parts = [CATALOG_SQL.strip()] + [c.strip() for c in ctes]
    return "with " + ",\n".join(parts) + "\n" + select.strip()


def r6(c: str | Column) -> Column:
    """Floats are reported rounded to 6 decimals on both sides of the check."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
