"""Catalogue extraction and profiling (rows 36-40, 92-96).

The reference describes these only in prose; the definitions are ours and are
stated in each function.  All are aggregates or per-row expressions; quantiles
are exact at every size (``quantiles.exact_quantiles``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of
from .quantiles import exact_quantiles

# Fixed values (our definitions): unit words and the base unit each maps to,
# with the factor to that base unit.
UNIT_BASE = {
    "oz": ("g", 28.349523125), "ounce": ("g", 28.349523125), "ounces": ("g", 28.349523125),
    "lb": ("g", 453.59237), "lbs": ("g", 453.59237), "pound": ("g", 453.59237), "pounds": ("g", 453.59237),
    "g": ("g", 1.0), "gram": ("g", 1.0), "grams": ("g", 1.0),
    "kg": ("g", 1000.0), "kgs": ("g", 1000.0), "kilogram": ("g", 1000.0), "kilograms": ("g", 1000.0),
    "ml": ("ml", 1.0), "milliliter": ("ml", 1.0), "milliliters": ("ml", 1.0),
    "l": ("ml", 1000.0), "liter": ("ml", 1000.0), "liters": ("ml", 1000.0),
    "count": ("count", 1.0), "ct": ("count", 1.0), "pack": ("count", 1.0),
}
# explicit letter classes instead of \b: Java and RE2 disagree on \b next to
# accented letters
QTY_PATTERN = (r"(\d+(?:\.\d+)?)\s*(" + "|".join(sorted(UNIT_BASE, key=len, reverse=True))
               + r")(?:[^\p{L}\p{N}_]|$)")
# "pack of 6", "pack: 6", "6 pack", "6-pack", "6 ct", "6 count"
PACK_OF = r"(?:pack|case|set)\s*(?:of|:)\s*(\d+)"
PACK_COUNT = r"(\d+)\s*-?\s*(?:pack|ct|count)(?:[^\p{L}\p{N}_]|$)"
# a key of any length, a colon with white space after it, a value
KEY_VALUE = r"^\s*([^:\s](?:[^:]*[^:\s])?)\s*:\s+(\S(?:[\s\S]*\S)?)\s*$"

# Fixed values (our definitions): keyword lists of the category flags.
CATEGORY_WORDS = {
    "is_food": ["food", "snack", "coffee", "tea", "sauce", "chocolate", "organic"],
    "is_health": ["vitamin", "supplement", "protein", "health", "medical"],
    "is_premium": ["premium", "luxury", "deluxe", "gourmet", "promo"],
}


def extract_quantity(text: str | Column) -> list[Column]:
    """First ``<number> <unit>`` in the lowercased text: value, unit, value in
    the base unit (g, ml or count); and the pack size (``pack of <n>``, else
    ``<n> pack``)."""
    t = F.lower(col_of(text))
    val = F.regexp_extract(t, QTY_PATTERN, 1)
    unit = F.regexp_extract(t, QTY_PATTERN, 2)
    base = F.create_map(*[x for k, (b, _) in UNIT_BASE.items() for x in (F.lit(k), F.lit(b))])
    fac = F.create_map(*[x for k, (_, f) in UNIT_BASE.items() for x in (F.lit(k), F.lit(f))])
    v = F.when(val != "", val.cast("double"))
    return [v.alias("qty_value"), F.when(unit != "", unit).alias("qty_unit"),
            F.element_at(base, unit).alias("base_unit"), (v * F.element_at(fac, unit)).alias("qty_base"),
            pack_size(t).alias("pack_size")]


def pack_size(lowered: Column) -> Column:
    of, count = F.regexp_extract(lowered, PACK_OF, 1), F.regexp_extract(lowered, PACK_COUNT, 1)
    return F.when(of != "", of).when(count != "", count).try_cast("long")


def extract_brand(text: str | Column) -> Column:
    """``Brand#<n>`` when present, else the first word."""
    t = col_of(text)
    tag = F.regexp_extract(t, r"(Brand#\d+)", 1)
    first = F.regexp_extract(t, r"^\s*(\S+)", 1)
    return F.when(tag != "", tag).otherwise(F.when(first != "", first))


def category_flags(text: str | Column) -> list[Column]:
    t = F.lower(col_of(text))
    return [F.when(t.rlike(category_pattern(ws)), 1).otherwise(0).alias(name) for name, ws in CATEGORY_WORDS.items()]


def category_pattern(words: list[str]) -> str:
    return r"(^|[^\p{L}\p{N}_])(" + "|".join(words) + r")([^\p{L}\p{N}_]|$)"


def bullet_stats(text: str | Column) -> list[Column]:
    """Lines starting with a bullet mark; ``Key: value`` lines, counted and as
    ``key=value`` in order."""
    lines = F.split(col_of(text), "\n")
    pairs = F.filter(lines, lambda x: x.rlike(KEY_VALUE))
    part = lambda x, k: F.regexp_extract(x, KEY_VALUE, k)
    return [F.size(F.filter(lines, lambda x: x.rlike(r"^\s*([-*•]|\d+[.)])\s+"))).alias("n_bullets"),
            F.size(pairs).alias("n_key_values"),
            F.transform(pairs, lambda x: F.concat(part(x, 1), F.lit("="), part(x, 2))).alias("key_values")]


def price_distribution(df: DataFrame, price: str = "price") -> DataFrame:
    p = F.col(price)
    (q,) = exact_quantiles(df, [price], [0.05, 0.25, 0.5, 0.75, 0.95])
    quantiles = F.lit(None).cast("array<double>") if q is None else F.array(*[F.lit(v) for v in q])
    return df.agg(
        F.count(p).alias("n"), F.min(p).alias("min"), F.max(p).alias("max"), F.avg(p).alias("mean"),
        F.first(quantiles).alias("quantiles"),
        F.skewness(p).alias("skew"), F.avg(F.log(p)).alias("log_mean"), F.stddev_pop(F.log(p)).alias("log_std"),
    )


def log_histogram(df: DataFrame, price: str = "price") -> DataFrame:
    return df.groupBy(F.floor(F.log10(price)).alias("log10_bucket")).agg(F.count(F.lit(1)).alias("n"))


def quality_profile(df: DataFrame, cols: list[str], id_col: str = "sample_id") -> DataFrame:
    """Missing and distinct counts per column, rows and distinct ids, in one row.

    Every value is reduced to a 128-bit digest while scanning, so neither texts
    nor vectors are shuffled; digests are counted with map-side aggregation."""
    names = [*cols, id_col]
    cells = F.array(*[F.struct(F.lit(i).alias("k"), F.unhex(F.md5(F.col(c).cast("string").cast("binary"))).alias("v"))
                      for i, c in enumerate(names)])
    seen = df.select(F.explode(cells).alias("x")).groupBy("x.k", "x.v").agg(F.count(F.lit(1)).alias("n"))
    per = seen.groupBy("k").agg(F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("missing"),
                                F.count("v").alias("distinct"), F.sum("n").alias("rows"))
    at = lambda i, c: F.coalesce(F.max(F.when(F.col("k") == i, F.col(c))), F.lit(0)).cast("long")
    out = []
    for i, c in enumerate(cols):
        out += [at(i, "missing").alias(f"{c}__missing"), at(i, "distinct").alias(f"{c}__distinct")]
    return per.agg(*out, at(len(cols), "rows").alias("rows"), at(len(cols), "distinct").alias("distinct_ids"))


def outlier_flags(df: DataFrame, price: str = "price", id_col: str = "sample_id") -> DataFrame:
    """Outside [Q1 − 1.5·IQR, Q3 + 1.5·IQR]."""
    (q,) = exact_quantiles(df, [price], [0.25, 0.75])
    q1, q3 = q or (None, None)
    lo, hi = (F.lit(None), F.lit(None)) if q is None else (F.lit(q1 - 1.5 * (q3 - q1)), F.lit(q3 + 1.5 * (q3 - q1)))
    p = F.col(price)
    return df.select(id_col, price, ((p < lo) | (p > hi)).alias("outlier"))


def correlation(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation; null when either column is constant (no division
    by a zero spread, which ANSI mode would raise)."""
    a, b = col_of(x), col_of(y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def price_tiers(df: DataFrame, price: str = "price") -> DataFrame:
    """Quartile tiers: count and mean price per tier."""
    (q,) = exact_quantiles(df, [price], [0.25, 0.5, 0.75])
    q1, q2, q3 = (F.lit(v).cast("double") for v in q or [None] * 3)
    p = F.col(price)
    tier = F.when(p <= q1, "budget").when(p <= q2, "value").when(p <= q3, "mid").otherwise("premium")
    return df.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_price"))
