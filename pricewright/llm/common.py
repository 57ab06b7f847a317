"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, free_shuffles, scratch_path, table_path  # noqa: F401  (re-exported to the operators)

#: Words of the size and shingle rules: runs of anything but ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
MIN_LONG = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file on the machine that asks: a path as it is, a
    bare name among the files of the installed ``public_tokenizers``."""
    return name if os.path.dirname(name) else public_tokenizers.path(name)


def filled(c: str = "text") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts go to Python in Arrow batches of at most so many rows, which bounds
    a worker's memory; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def text_key(c: str = "text") -> Column:
    """Equal texts have equal keys; null counts as empty."""
    return F.md5(filled(c).cast("binary"))


def fold(mod: int, c: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod ``mod``; null without an id."""
    return (F.crc32(F.col(c).cast("string").cast("binary")) % mod).cast("int")


def uniform(seed: str, *cols: Column) -> Column:
    """A number in [0, 1) that only the seed and the given values decide
    (52 bits of an md5, so DuckDB can draw the same)."""
    text = F.concat_ws(":", F.lit(seed), *cols)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def slices(text: str, size: int = 1 << 20):
    """The text in pieces of about ``size`` characters that end after white
    space, so that memory stays bounded on very long texts.  A run without
    white space that is longer than twice the size is cut inside."""
    at, n = 0, len(text)
    while at < n:
        to = at + size
        if to < n:
            while to < min(n, at + 2 * size) and not text[to - 1].isspace():
                to += 1
        yield text[at:to]
        at = to


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash, element by element (wraps around)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def with_columns_of(df: DataFrame, **cols: Column) -> DataFrame:
    """Adds columns; a column of the input that already has such a name is
    replaced, whatever its case."""
    taken = {c.lower() for c in cols}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken],
                     *[v.alias(k) for k, v in cols.items()])
