"""Queries for numeric column handling, metrics, folds and seeded draws
(rows 26-33, 45-52, 77-78, 91)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as tx
from ..functions.hashing import salted, uniform01
from ..operators import metrics as M
from ..operators import select as S
from ..operators.folds import fold_table
from ..operators.select import array_width
from ..sources.tables import catalog, read_table, train_test
from . import sqlfrag as q
from .registry import r6, register, with_catalog

# ---- rows 26-28: column roles and null fill ---------------------------------------------


@register("common_numeric_select", with_catalog(select="""
select sample_id, p_size, n_chars, price_raw, has_visual from catalog where fold <> 0"""))
def q_common_numeric(spark: SparkSession, sf: str) -> DataFrame:
    train, test = train_test(catalog(spark, sf))
    test = test.drop("price")
    cols = S.common_numeric(train, test, exclude=("price", "sample_id", "fold"))
    return S.fill_numeric_nulls(train.select("sample_id", *cols), cols)


@register("feature_column_discovery", """
select cast(vec_id as varchar) sample_id, [label::float] || embedding features from embeddings""")
def q_feature_discovery(spark, sf):
    # a wide table (label + f_0..f_63); discovery finds every numeric column but the id
    emb = read_table(spark, sf, "embeddings")
    wide = emb.select(F.col("vec_id").alias("sample_id"), "label",
                      *[F.col("embedding")[i].alias(f"f_{i}") for i in range(array_width(emb, "embedding"))])
    cols = S.feature_columns(wide, "sample_id")
    return wide.select(F.col("sample_id").cast("string").alias("sample_id"),
                       F.array(*[F.col(c).cast("float") for c in cols]).alias("features"))


@register("numeric_null_fill", with_catalog(select="""
select sample_id, coalesce(quality, 0)::double quality, coalesce(toxic, 0)::double toxic
from catalog left join labels on sample_id = cast(doc_id as varchar)"""))
def q_numeric_null_fill(spark, sf):
    lab = read_table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("sample_id"),
        F.col("quality").cast("double").alias("quality"), F.col("toxic").cast("double").alias("toxic"))
    j = catalog(spark, sf).select("sample_id").join(lab, "sample_id", "left")
    return S.fill_numeric_nulls(j, ["quality", "toxic"])


# ---- rows 29-33: non-finite values, clipping, floors, assembly -------------------------------

_RATIO_SQL = ("case when l_discount <> 0 then l_tax / l_discount when l_tax = 0 then 'nan'::double "
              "else sign(l_tax) * 'inf'::double end")


def _li_ratio(spark, sf) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", N.ieee_ratio("l_tax", "l_discount").alias("ratio"))


@register("nan_inf_to_zero", f"""
select l_orderkey, l_linenumber, round(case when isfinite(r) then r else 0 end, 6) ratio
from (select *, {_RATIO_SQL} r from lineitem)""")
def q_nan_inf_to_zero(spark, sf):
    return _li_ratio(spark, sf).select("l_orderkey", "l_linenumber", r6(N.zero_nonfinite("ratio")).alias("ratio"))


@register("finite_row_filter", f"""
select l_orderkey, l_linenumber, round(r, 6) ratio from (select *, {_RATIO_SQL} r from lineitem) where isfinite(r)""")
def q_finite_row_filter(spark, sf):
    feats = _li_ratio(spark, sf).select(
        "l_orderkey", "l_linenumber", "ratio", F.array("l_quantity", "ratio").alias("x"))
    kept = feats.filter(N.all_finite("x"))
    return kept.select("l_orderkey", "l_linenumber", r6("ratio").alias("ratio"))


@register("nonfinite_count", f"""
select sum(case when isfinite(r) then 0 else 1 end) dropped, count(*) n from (select {_RATIO_SQL} r from lineitem)""")
def q_nonfinite_count(spark, sf):
    return _li_ratio(spark, sf).agg(
        F.sum(F.when(N.is_finite("ratio"), 0).otherwise(1)).alias("dropped"), F.count(F.lit(1)).alias("n"))


_CLIP_SQL = "[l_quantity / 10.0, l_extendedprice / 1000.0, l_discount * 100 - 5, l_tax * 100 - 5]"


@register("clip_features", f"""
select l_orderkey, l_linenumber, list_transform({_CLIP_SQL}, lambda x: round(greatest(-10.0, least(10.0, x)), 6)) x
from lineitem""")
def q_clip(spark, sf):
    li = read_table(spark, sf, "lineitem")
    x = F.array(F.col("l_quantity") / 10.0, F.col("l_extendedprice") / 1000.0,
                F.col("l_discount") * 100 - 5, F.col("l_tax") * 100 - 5)
    return li.select("l_orderkey", "l_linenumber",
                     F.transform(N.clip_array(x), lambda v: F.round(v, 6)).alias("x"))


@register("price_floor", with_catalog(select="select sample_id, round(greatest(price - 20, 0.01), 6) price from catalog"))
def q_price_floor(spark, sf):
    return catalog(spark, sf).select("sample_id", r6(N.price_floor(F.col("price") - 20)).alias("price"))


@register("feature_assemble", with_catalog(select=f"""
select sample_id, list_transform([{q.char_count('catalog_content')}, {q.word_count('catalog_content')},
  p_size::double, n_chars, has_visual] || coalesce(embedding::double[], list_transform(range(64), lambda i: 0.0e0)),
  lambda v: round(v, 6)) features from catalog"""))
def q_feature_assemble(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    cat = catalog(spark, sf)
    width = array_width(cat, "embedding")
    zeros = F.array_repeat(F.lit(0.0).cast("float"), width)
    df = cat.select("sample_id", tx.char_count("catalog_content").cast("double").alias("c"),
                    tx.word_count("catalog_content").cast("double").alias("w"),
                    F.col("p_size").cast("double").alias("p_size"), "n_chars", "has_visual",
                    F.coalesce("embedding", zeros).alias("vis"))
    df = df.select("*", *[F.col("vis")[i].cast("double").alias(f"v{i}") for i in range(width)])
    va = VectorAssembler(inputCols=["c", "w", "p_size", "n_chars", "has_visual"] + [f"v{i}" for i in range(width)],
                         outputCol="fv", handleInvalid="keep")
    return va.transform(df).select(
        "sample_id", F.transform(vector_to_array("fv"), lambda v: F.round(v, 6)).alias("features"))


# ---- rows 45-52: metrics and summaries ------------------------------------------------------

@register("smape", f"select round({q.smape('l_discount', 'l_tax')}, 6) smape, count(*) n from lineitem")
def q_smape(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.agg(r6(M.smape("l_discount", "l_tax")).alias("smape"), F.count(F.lit(1)).alias("n"))


@register("smape_drop_zero", f"""
select round({q.smape_drop_zero('l_discount', 'l_tax')}, 6) smape,
  sum(case when l_tax <> 0 or l_discount <> 0 then 1 else 0 end) n from lineitem""")
def q_smape_drop_zero(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.agg(r6(M.smape_drop_zero("l_discount", "l_tax")).alias("smape"),
                  F.sum(F.when((F.col("l_tax") != 0) | (F.col("l_discount") != 0), 1).otherwise(0)).alias("n"))


@register("smape_by_group", with_catalog(
    f"g as (select fold, {q.smape('5 + 0.8 * p_size', 'price')} s, count(*) n from catalog group by fold)",
    select="select fold, round(s, 6) smape, n, round(avg(s) over (), 6) mean_smape from g"))
def q_smape_by_group(spark, sf):
    cat = catalog(spark, sf).withColumn("pred", F.lit(5.0) + F.lit(0.8) * F.col("p_size"))
    out = M.smape_by_group(cat, "pred", "price", "fold")
    return out.select("fold", r6("smape").alias("smape"), "n", r6("mean_smape").alias("mean_smape"))


@register("mae", "select round(avg(abs(l_discount - l_tax)), 6) mae from lineitem")
def q_mae(spark, sf):
    return read_table(spark, sf, "lineitem").agg(r6(M.mae("l_discount", "l_tax")).alias("mae"))


@register("target_stats", with_catalog(select="""
select count(*) n, round(avg(price), 6) mean, round(stddev_pop(price), 6) std_pop from catalog where fold <> 0"""))
def q_target_stats(spark, sf):
    train, _ = train_test(catalog(spark, sf))
    return M.target_stats(train, "price").select("n", r6("mean").alias("mean"), r6("std_pop").alias("std_pop"))


@register("prediction_summary", """
select round(min(o_totalprice), 6) min, round(max(o_totalprice), 6) max, round(avg(o_totalprice), 6) mean,
  round(stddev_pop(o_totalprice), 6) std from orders""")
def q_prediction_summary(spark, sf):
    s = M.prediction_summary(read_table(spark, sf, "orders"), "o_totalprice")
    return s.select(*[r6(c).alias(c) for c in s.columns])


@register("feature_block_widths", with_catalog(
    f"st as (select {q.text_stats('catalog_content')} from catalog)", select=f"""
select 'text_stats' block, count(*) n_rows, max(len([{', '.join(tx.TEXT_STATS)}]))::int width from st
union all select 'structured', count(*), max(len([p_size::double, n_chars, price_raw, has_visual]))::int from catalog
union all select 'visual', count(*), max(len(embedding))::int from catalog"""))
def q_feature_block_widths(spark, sf):
    cat = catalog(spark, sf)
    train, test = train_test(cat)
    numbers = S.common_numeric(train, test.drop("price"), exclude=("price", "sample_id", "fold"))
    blocks = cat.select(F.explode(F.array(
        F.struct(F.lit("text_stats").alias("block"), F.size(F.array(*tx.text_stats("catalog_content"))).alias("w")),
        F.struct(F.lit("structured").alias("block"), F.size(F.array(*[F.col(c).cast("double") for c in numbers])).alias("w")),
        F.struct(F.lit("visual").alias("block"), F.size("embedding").alias("w")))).alias("b"))
    widths = blocks.groupBy("b.block").agg(F.count(F.lit(1)).alias("n_rows"), F.max("b.w").alias("width"))
    return widths.select("block", "n_rows", "width")


# ---- rows 77-78, 91: folds, split, seeded baseline -----------------------------------------------

@register("fold_assign", with_catalog(select=f"select sample_id, {q.balanced_fold('sample_id', 5, 42)} fold from catalog"))
def q_fold_assign(spark, sf):
    return fold_table(catalog(spark, sf).select("sample_id"), 5, 42, name="fold")


@register("train_test_split", with_catalog(select=f"""
select sample_id, case when {q.uniform01("'42:' || sample_id")} < 0.8 then 'train' else 'test' end split from catalog"""))
def q_train_test_split(spark, sf):
    u = uniform01(salted(F.col("sample_id"), 42))
    return catalog(spark, sf).select("sample_id", F.when(u < 0.8, "train").otherwise("test").alias("split"))


@register("random_baseline", with_catalog(select=f"""
select sample_id, round(5 + 495 * {q.uniform01("'42:' || sample_id")}, 2) price from catalog where fold = 0"""))
def q_random_baseline(spark, sf):
    _, test = train_test(catalog(spark, sf))
    u = uniform01(salted(F.col("sample_id"), 42))
    return test.select("sample_id", F.round(F.lit(5.0) + F.lit(495.0) * u, 2).alias("price"))
