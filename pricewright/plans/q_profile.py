"""Queries for the README-defined extraction and profiling rows (36-40, 92-96)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..sources.tables import catalog
from .registry import r6, register, with_catalog

_LOW = "lower(catalog_content)"


def _unit_case(idx: int) -> str:
    parts = " ".join(f"when '{k}' then {repr(v[idx]) if isinstance(v[idx], str) else repr(v[idx])}"
                     for k, v in P.UNIT_BASE.items())
    return f"case u {parts} end"


@register("extract_quantity_unit", with_catalog(
    f"x as (select sample_id, regexp_extract({_LOW}, '{P.QTY_PATTERN}', 1) v, "
    f"regexp_extract({_LOW}, '{P.QTY_PATTERN}', 2) u, regexp_extract({_LOW}, '{P.PACK_OF}', 1) po, "
    f"regexp_extract({_LOW}, '{P.PACK_COUNT}', 1) pc from catalog)",
    select=f"""
select sample_id, case when v <> '' then v::double end qty_value, case when u <> '' then u end qty_unit,
  {_unit_case(0)} base_unit, round(case when v <> '' then v::double end * {_unit_case(1)}, 6) qty_base,
  case when po <> '' then try_cast(po as bigint) when pc <> '' then try_cast(pc as bigint) end pack_size from x"""))
def q_extract_quantity(spark, sf):
    cols = P.extract_quantity("catalog_content")
    df = catalog(spark, sf).select("sample_id", *cols)
    return df.withColumn("qty_base", r6("qty_base"))


@register("extract_brand", with_catalog(select=r"""
select sample_id, case when regexp_extract(catalog_content, '(Brand#\d+)', 1) <> ''
  then regexp_extract(catalog_content, '(Brand#\d+)', 1)
  else nullif(regexp_extract(catalog_content, '^\s*(\S+)', 1), '') end brand from catalog"""))
def q_extract_brand(spark, sf):
    return catalog(spark, sf).select("sample_id", P.extract_brand("catalog_content").alias("brand"))


@register("category_flags", with_catalog(select="select sample_id, " + ", ".join(
    f"case when regexp_matches({_LOW}, '{P.category_pattern(ws)}') then 1 else 0 end {name}"
    for name, ws in P.CATEGORY_WORDS.items()) + " from catalog"))
def q_category_flags(spark, sf):
    return catalog(spark, sf).select("sample_id", *P.category_flags("catalog_content"))


@register("bullet_value_extract", with_catalog(select=rf"""
select sample_id,
  len(list_filter(string_split(catalog_content, chr(10)), lambda x: regexp_matches(x, '^\s*([-*•]|\d+[.)])\s+'))) n_bullets,
  len(list_filter(string_split(catalog_content, chr(10)), lambda x: regexp_matches(x, '{P.KEY_VALUE}'))) n_key_values,
  list_transform(list_filter(string_split(catalog_content, chr(10)), lambda x: regexp_matches(x, '{P.KEY_VALUE}')),
    lambda x: regexp_extract(x, '{P.KEY_VALUE}', 1) || '=' || regexp_extract(x, '{P.KEY_VALUE}', 2)) key_values
from catalog"""))
def q_bullet_value_extract(spark, sf):
    return catalog(spark, sf).select("sample_id", *P.bullet_stats("catalog_content"))


@register("price_distribution", with_catalog(select="""
select count(price) n, round(min(price), 6) min, round(max(price), 6) max, round(avg(price), 6) mean,
  list_transform(quantile_cont(price, [0.05, 0.25, 0.5, 0.75, 0.95]), lambda v: round(v, 6)) quantiles,
  round(avg(power(price - (select avg(price) from catalog), 3)) / power(stddev_pop(price), 3), 6) skew,
  round(avg(ln(price)), 6) log_mean, round(stddev_pop(ln(price)), 6) log_std from catalog"""))
def q_price_distribution(spark, sf):
    d = P.price_distribution(catalog(spark, sf))
    return d.select("n", *[r6(c).alias(c) for c in ("min", "max", "mean")],
                    F.transform("quantiles", lambda v: F.round(v, 6)).alias("quantiles"),
                    *[r6(c).alias(c) for c in ("skew", "log_mean", "log_std")])


@register("price_log_histogram", with_catalog(select="""
select floor(log10(price))::bigint log10_bucket, count(*) n from catalog group by 1"""))
def q_price_log_histogram(spark, sf):
    return P.log_histogram(catalog(spark, sf))


_QCOLS = ["sample_id", "catalog_content", "image_link", "p_brand", "p_type", "p_size", "n_chars", "price_raw", "price",
          "embedding", "has_visual", "fold"]


@register("data_quality_profile", with_catalog(select="select " + ", ".join(
    f"sum(case when {c} is null then 1 else 0 end) {c}__missing, count(distinct {c}) {c}__distinct" for c in _QCOLS)
    + ", count(*) rows, count(distinct sample_id) distinct_ids from catalog"))
def q_data_quality_profile(spark, sf):
    return P.quality_profile(catalog(spark, sf), _QCOLS)


@register("outlier_flags", with_catalog(
    "q as (select quantile_cont(price, 0.25) q1, quantile_cont(price, 0.75) q3 from catalog)",
    select="""select sample_id, round(price, 6) price,
  price < q1 - 1.5 * (q3 - q1) or price > q3 + 1.5 * (q3 - q1) outlier from catalog, q"""))
def q_outlier_flags(spark, sf):
    return P.outlier_flags(catalog(spark, sf)).withColumn("price", r6("price"))


_CORR_COLS = ("p_size", "n_chars", "has_visual", "price_raw")
_CORR_SQL = ", ".join(f"round(covar_pop({c}, price) / nullif(stddev_pop({c}) * stddev_pop(price), 0), 6) {c}"
                      for c in _CORR_COLS)


@register("feature_price_correlation", with_catalog(select=f"select {_CORR_SQL} from catalog"))
def q_feature_price_correlation(spark, sf):
    cat = catalog(spark, sf)
    return cat.agg(*[r6(P.correlation(c, "price")).alias(c) for c in _CORR_COLS])


@register("price_tiers", with_catalog(
    "q as (select quantile_cont(price, 0.25) q1, quantile_cont(price, 0.5) q2, quantile_cont(price, 0.75) q3 from catalog)",
    select="""select case when price <= q1 then 'budget' when price <= q2 then 'value' when price <= q3 then 'mid'
  else 'premium' end tier, count(*) n, round(avg(price), 6) mean_price from catalog, q group by 1"""))
def q_price_tiers(spark, sf):
    return P.price_tiers(catalog(spark, sf)).withColumn("mean_price", r6("mean_price"))
