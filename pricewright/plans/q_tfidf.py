"""TF-IDF queries (rows 54-55, 59-63) over the catalogue text.

Parameters are the main pipeline's: words 1-2-grams without English stop
words, min_df 5, max_df 0.8, 15,000 terms; char_wb 2-4-grams, min_df 8,
max_df 0.8, 5,000 terms; sublinear tf, accents stripped.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tfidf as T
from ..sources.tables import catalog, train_test
from . import sqlfrag as q
from .features import CHAR, WORD
from .registry import r6, register, with_catalog

TEXT = "catalog_content"


# ---- DuckDB twins ---------------------------------------------------------------------------

def _word_terms_sql(name: str, stop: bool, ngram_max: int, accents: bool = True) -> str:
    toks = q.word_tokens(q.analyzer_text(TEXT) if accents else f"lower(coalesce({TEXT}, ''))")
    if stop:
        toks = q.remove_stop_words(toks)
    arms = [f"select sample_id, fold, unnest(w) term from {name}_t"]
    if ngram_max >= 2:
        arms.append(f"select sample_id, fold, unnest(list_transform(range(1, len(w)), "
                    f"lambda i: w[i] || ' ' || w[i + 1])) term from {name}_t")
    return (f"{name}_t as (select sample_id, fold, {toks} w from catalog),\n"
            f"{name}_terms as ({' union all '.join(arms)})")


def _char_terms_sql(name: str, n_min: int, n_max: int) -> str:
    arms = [f"select sample_id, fold, substr(w, i, {n}) term from (select *, unnest(range(1, L - {n} + 2)) i "
            f"from {name}_ws where L >= {n})" for n in range(n_min, n_max + 1)]
    arms.append(f"select sample_id, fold, w term from {name}_ws where L < {n_min}")
    return (f"{name}_ws as (select sample_id, fold, w, length(w) L from (select sample_id, fold, "
            f"' ' || unnest({q.words(q.analyzer_text(TEXT))}) || ' ' w from catalog)),\n"
            f"{name}_terms as ({' union all '.join(arms)})")


def tfidf_ctes(name: str, p: T.TfidfParams) -> list[str]:
    a = p.analyzer
    terms = (_char_terms_sql(name, a.ngram_min, a.ngram_max) if a.kind == "char_wb"
             else _word_terms_sql(name, a.stop_words, a.ngram_max, a.strip_accents))
    lo = f"{p.min_df} * n" if isinstance(p.min_df, float) and p.min_df < 1.0 else f"{p.min_df}"
    hi = f"{p.max_df} * n" if isinstance(p.max_df, float) and p.max_df <= 1.0 else f"{p.max_df}"
    lim = f"order by tc desc, term asc limit {p.max_features}" if p.max_features else ""
    return [
        terms,
        f"{name}_tf as (select sample_id, fold, term, count(*) tf from {name}_terms group by all)",
        f"{name}_n as (select count(*)::double n from catalog where fold <> 0)",
        f"{name}_st as (select term, count(*) df, sum(tf) tc from {name}_tf where fold <> 0 group by term)",
        f"{name}_voc as (select '{p.prefix}' || term term, df, tc, ln((1 + n) / (1 + df)) + 1 idf "
        f"from {name}_st, {name}_n where df >= {lo} and df <= {hi} {lim})",
        f"{name}_w0 as (select sample_id, term, (1 + ln(tf)) * idf w from "
        f"(select sample_id, '{p.prefix}' || term term, tf from {name}_tf) join {name}_voc using (term))",
        f"{name}_w as (select sample_id, term, w / sqrt(sum(w * w) over (partition by sample_id)) weight "
        f"from {name}_w0)",
    ]


# ---- Spark side ---------------------------------------------------------------------------------

def tfidf_all(spark: SparkSession, sf: str, p: T.TfidfParams) -> tuple[DataFrame, DataFrame]:
    """Vocabulary fitted on the train fold; weights for train and test rows."""
    train, test = train_test(catalog(spark, sf))
    vocab, (w_train, w_test) = T.fit_transform(train, [test], TEXT, p)
    return vocab, w_train.unionByName(w_test)


@register("term_document_frequency", with_catalog(
    _word_terms_sql("a", False, 1),
    "a_tf as (select sample_id, fold, term, count(*) tf from a_terms group by all)",
    select="select term, count(*) df, sum(tf) tc from a_tf where fold <> 0 group by term"))
def q_term_document_frequency(spark, sf):
    train, _ = train_test(catalog(spark, sf))
    return T.corpus_stats(train, TEXT, T.Analyzer("word", 1, 1))


@register("df_pruning", with_catalog(*tfidf_ctes("a", WORD)[:4], select="""
select term, df from a_st, a_n where df >= 5 and df <= 0.8 * n"""))
def q_df_pruning(spark, sf):
    train, _ = train_test(catalog(spark, sf))
    p = T.TfidfParams(WORD.analyzer, min_df=5, max_df=0.8, max_features=None)
    return T.fit_vocabulary(T.corpus_stats(train, TEXT, p.analyzer), T.n_docs_of(train), p).select("term", "df")


@register("vocabulary_topk", with_catalog(*tfidf_ctes("a", WORD)[:5], select="""
select term, df, tc, round(idf, 6) idf from a_voc"""))
def q_vocabulary_topk(spark, sf):
    train, _ = train_test(catalog(spark, sf))
    v = T.fit_vocabulary(T.corpus_stats(train, TEXT, WORD.analyzer), T.n_docs_of(train), WORD)
    return v.select("term", "df", "tc", r6("idf").alias("idf"))


@register("word_tfidf", with_catalog(*tfidf_ctes("a", WORD), select="""
select sample_id, term, round(weight, 6) weight from a_w"""))
def q_word_tfidf(spark, sf):
    _, w = tfidf_all(spark, sf, WORD)
    return w.select("sample_id", "term", r6("weight").alias("weight"))


@register("char_tfidf", with_catalog(*tfidf_ctes("b", CHAR), select="""
select sample_id, term, round(weight, 6) weight from b_w"""))
def q_char_tfidf(spark, sf):
    _, w = tfidf_all(spark, sf, CHAR)
    return w.select("sample_id", "term", r6("weight").alias("weight"))


@register("text_hstack", with_catalog(*tfidf_ctes("a", WORD), *tfidf_ctes("b", CHAR), select="""
select sample_id, substr(term, 1, 1) block, count(*) n_terms, round(sum(weight), 6) sum_weight,
  round(sum(weight * weight), 6) sq_norm
from (select * from a_w union all select * from b_w) group by sample_id, substr(term, 1, 1)"""))
def q_text_hstack(spark, sf):
    train, test = train_test(catalog(spark, sf))
    _, (a, b) = T.fit_transform_blocks(train, [test], TEXT, [WORD, CHAR])
    both = a.unionByName(b)  # the blocks stay apart by their term prefix
    return both.groupBy("sample_id", F.substring("term", 1, 1).alias("block")).agg(
        F.count(F.lit(1)).alias("n_terms"), r6(F.sum("weight")).alias("sum_weight"),
        r6(F.sum(F.col("weight") * F.col("weight"))).alias("sq_norm"))


# The settings of the reference's ladder.  The settings after them
# show what cannot be used, and what has no term.
_LADDERS = {
    "word": [WORD, T.TfidfParams(T.Analyzer("word", 1, 1, strip_accents=False), min_df=10, max_df=0.9, max_features=8000)],
    "char": [CHAR],
    "invalid": [dataclasses.replace(WORD, max_df=1.5), dataclasses.replace(WORD, max_features=0),
                dataclasses.replace(CHAR, analyzer=T.Analyzer("char_wb", 4, 2))],
    "rare": [dataclasses.replace(WORD, min_df=1_000_000_000), dataclasses.replace(WORD, max_features=40)],
    "none": [dataclasses.replace(CHAR, min_df=1_000_000_000)],
}
SVD_WIDTH = 150


def _ladder_sql() -> str:
    ctes, arms = [], []
    for name, ladder in _LADDERS.items():
        for k, p in enumerate(ladder):
            key = f"{name}_{k}"
            if T.invalid(p):
                ctes.append(f"{key}_n_terms as (select 0::bigint n, '{T.invalid(p).replace(chr(39), '')}' why)")
            else:
                ctes += tfidf_ctes(key, p)[:5]
                ctes.append(f"{key}_n_terms as (select count(*) n, case when count(*) = 0 then 'empty vocabulary' end why from {key}_voc)")
            earlier = " and ".join(["why is null", *[f"(select why from {name}_{j}_n_terms) is not null" for j in range(k)]])
            arms.append(f"select '{name}' block, {k} step, why reason, n n_terms, {earlier} chosen, "
                        f"least({SVD_WIDTH}, n)::int svd_width from {key}_n_terms")
    return with_catalog(*ctes, select=" union all ".join(arms))


@register("tfidf_config_ladder", _ladder_sql())
def q_tfidf_config_ladder(spark, sf):
    """One row a setting: why it is unusable, its terms, whether the ladder stops
    there, and the width of its SVD (an empty block has none)."""
    train, _ = train_test(catalog(spark, sf))
    train = train.select("sample_id", TEXT)
    stats = T.kept_stats(train, TEXT, [p for ladder in _LADDERS.values() for p in ladder])
    rows = []
    for name, ladder in _LADDERS.items():
        for k, r in enumerate(T.climb(train, TEXT, ladder, stats=stats)):
            rows.append((name, k, r.reason, r.n_terms, r.chosen, min(SVD_WIDTH, r.n_terms)))
    return spark.createDataFrame(rows, "block string, step int, reason string, n_terms long, chosen boolean, svd_width int")
