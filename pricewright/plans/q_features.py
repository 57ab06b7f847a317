"""Queries for scalers, feature blocks and the visual join (rows 41, 65-66, 69-70)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import scale
from ..operators.visual import visual_dim, visual_join
from ..session import cut_lineage
from ..sources.tables import catalog, read_table, train_test
from ..sources.visual import visual_features
from . import sqlfrag as q
from .registry import r6, register, with_catalog

_STATS = list(tx.TEXT_STATS)
_STATS_CTE = f"st as (select sample_id, fold, {q.text_stats('catalog_content')} from catalog)"


def _stats_frames(spark, sf):
    # every text is read once; the fit and the output read five numbers a row
    rows = cut_lineage(catalog(spark, sf).select("sample_id", "fold", *tx.text_stats("catalog_content")))
    train, test = train_test(rows)
    return train.drop("fold"), test.drop("fold")


def _std_sql(cols: list[str], src: str) -> str:
    """(x − train mean) / train population std (zero spread → 1) for all rows."""
    m = ", ".join(f"avg({c}) m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) s_{c}" for c in cols)
    sel = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) {c}" for c in cols)
    return f"select sample_id, {sel} from {src}, (select {m} from {src} where fold <> 0)"


@register("standard_scale", with_catalog(_STATS_CTE, select=_std_sql(_STATS, "st")))
def q_standard_scale(spark, sf):
    tr, te = _stats_frames(spark, sf)
    sc = scale.fit_standard(tr, _STATS)
    both = tr.unionByName(te)
    return both.select("sample_id", *[r6(sc.column(c)).alias(c) for c in _STATS])


@register("text_stats_block", with_catalog(_STATS_CTE, f"z as ({_std_sql(_STATS, 'st')})", select=f"""
select sample_id, [{', '.join(_STATS)}] stats from z"""))
def q_text_stats_block(spark, sf):
    tr, te = _stats_frames(spark, sf)
    sc = scale.fit_standard(tr, _STATS)
    return tr.unionByName(te).select("sample_id", F.array(*[r6(sc.column(c)) for c in _STATS]).alias("stats"))


_STRUCT = ["p_size", "n_chars"]


def _robust_sql(cols: list[str], src: str) -> str:
    m = ", ".join(f"quantile_cont({c}, 0.5) m_{c}, coalesce(nullif(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0), 1) s_{c}"
                  for c in cols)
    sel = ", ".join(f"round((coalesce({c}, 0) - m_{c}) / s_{c}, 6) {c}" for c in cols)
    return f"select sample_id, {sel} from {src}, (select {m} from {src} where fold <> 0)"


@register("robust_scale", with_catalog(select=_robust_sql(_STRUCT, "catalog")))
def q_robust_scale(spark, sf):
    train, test = train_test(catalog(spark, sf))
    tr = train.select("sample_id", *_STRUCT).na.fill(0.0, subset=_STRUCT)
    sc = scale.fit_robust(tr, _STRUCT)
    return catalog(spark, sf).select("sample_id", *_STRUCT).na.fill(0.0, subset=_STRUCT).select(
        "sample_id", *[r6(sc.column(c)).alias(c) for c in _STRUCT])


@register("structured_block", with_catalog(f"z as ({_robust_sql(_STRUCT, 'catalog')})", select=f"""
select sample_id, [{', '.join(_STRUCT)}] struct from z"""))
def q_structured_block(spark, sf):
    from ..operators import select as S

    train, test = train_test(catalog(spark, sf))
    cols = S.common_numeric(train, test.drop("price"),
                            exclude=("price", "sample_id", "fold", "has_visual", "price_raw"))
    tr = S.fill_numeric_nulls(train, cols)
    sc = scale.fit_robust(tr, cols)
    both = S.fill_numeric_nulls(catalog(spark, sf), cols)
    return both.select("sample_id", F.array(*[r6(sc.column(c)) for c in cols]).alias("struct"))


@register("visual_left_join", with_catalog(select="""
select sample_id, coalesce(embedding, list_transform(range(64), lambda i: 0.0::float)) visual,
  case when embedding is null then 0.0 else 1.0 end has_visual_flag from catalog"""))
def q_visual_left_join(spark, sf):
    vis = visual_features(read_table(spark, sf, "embeddings"), id_col="vec_id", vec_col="embedding")
    items = catalog(spark, sf).select("sample_id")
    return visual_join(items, vis, visual_dim(vis))
