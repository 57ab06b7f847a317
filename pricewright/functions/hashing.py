"""Deterministic per-row randomness derived from the row id.

Random shuffles (``KFold(shuffle=True)``, ``randomSplit``) depend on how rows
are partitioned; a hash of the id does not, so folds and seeded draws are
identical on 1 or 1000 executors and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296.0


def md5_bits32(key: Column) -> Column:
    """First 32 bits of md5(key) as a non-negative bigint."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def uniform01(key: Column) -> Column:
    """A draw in [0, 1) that is a pure function of the key."""
    return md5_bits32(key).cast("double") / F.lit(_TWO_32)


def salted(key: Column, seed: int | None) -> Column:
    """``'<seed>:<key>'`` so different seeds give independent draws."""
    if seed is None:
        return key.cast("string")
    return F.concat(F.lit(f"{seed}:"), key.cast("string"))


def fold_of(key: Column, k: int = 5, seed: int | None = 42) -> Column:
    """Fold number in [0, k): ``md5(seed:id) mod k``."""
    return (md5_bits32(salted(key, seed)) % F.lit(k)).cast("int")
