"""Compare a Spark query with its DuckDB oracle the way the driver does:
columns sorted by name, floats rounded, rows compared as a multiset."""

from __future__ import annotations

import math

import duckdb

from pricewright.sources.tables import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        r = round(v, digits)
        # keep the sign of zero: a byte-level value hash tells -0.0 from 0.0
        return "-0.0" if r == 0 and math.copysign(1.0, r) < 0 else r
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def rows_of(cols, rows, digits=6):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql, digits=6):
    scols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    sc, sr = rows_of(scols, srows, digits)
    dc, dr = rows_of(dcols, drows, digits)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duck={dc}")
    if len(sr) != len(dr):
        problems.append(f"row count spark={len(sr)} duck={len(dr)}")
    if not problems and sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {bad}")
    return problems, len(sr)
