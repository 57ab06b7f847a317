"""Queries for the catalogue view, text selection, clean-up and text statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import metrics as M
from ..operators import select as S
from ..operators import tfidf as T
from ..sources.tables import catalog, train_test
from . import sqlfrag as q
from .registry import r6, register, with_catalog


def brand_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: per brand, the train-fold mean price used as a predictor for the
    test fold, its SMAPE, and the normalised-text statistics of the test rows.

    Plan: the catalogue joins are planned once and their exchanges reused by the
    train and test branches; the per-brand means are a partial+final
    aggregation whose output (one row per brand) AQE broadcasts at run time.
    """
    cat = catalog(spark, sf).select(
        "sample_id", "p_brand", "price", "fold", *tx.text_stats(tx.normalize("catalog_content"))
    )
    train, test = train_test(cat)
    means = train.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n_train"), F.avg("price").alias("brand_mean")
    )
    return (
        test.join(means, "p_brand", "inner")
        .groupBy("p_brand", "n_train", "brand_mean")
        .agg(
            F.count(F.lit(1)).alias("n_test"),
            M.smape("brand_mean", "price").alias("smape"),
            F.avg("char_count").alias("mean_chars"),
            F.avg("word_count").alias("mean_words"),
            F.avg("digit_ratio").alias("mean_digit_ratio"),
        )
        .select(
            "p_brand", "n_train", "n_test", r6("brand_mean").alias("brand_mean"), r6("smape").alias("smape"),
            r6("mean_chars").alias("mean_chars"), r6("mean_words").alias("mean_words"),
            r6("mean_digit_ratio").alias("mean_digit_ratio"),
        )
    )


_STATS_T = "trim(regexp_replace(lower(coalesce(catalog_content,'')), '" + tx.WS + "+', ' ', 'g'))"

register("brand_baseline", with_catalog(
    f"s as (select sample_id, p_brand, price, fold, {q.text_stats('t')} from (select *, {_STATS_T} t from catalog))",
    "m as (select p_brand, count(*) n_train, avg(price) brand_mean from s where fold <> 0 group by p_brand)",
    select=f"""
select p_brand, n_train, count(*) n_test, round(brand_mean, 6) brand_mean,
  round({q.smape('brand_mean', 'price')}, 6) smape,
  round(avg(char_count), 6) mean_chars, round(avg(word_count), 6) mean_words,
  round(avg(digit_ratio), 6) mean_digit_ratio
from s join m using (p_brand) where fold = 0 group by p_brand, n_train, brand_mean""",
))(brand_baseline)


@register("catalog_view", with_catalog(select="""
select sample_id, catalog_content, image_link, p_brand, p_type, p_size, n_chars, price_raw,
  round(price, 6) price, has_visual, fold, len(embedding) visual_dim from catalog"""))
def q_catalog(spark, sf):
    return catalog(spark, sf).select(
        "sample_id", "catalog_content", "image_link", "p_brand", "p_type", "p_size", "n_chars", "price_raw",
        r6("price").alias("price"), "has_visual", "fold",
        F.when(F.col("embedding").isNull(), F.lit(None).cast("int")).otherwise(F.size("embedding")).alias("visual_dim"),
    )


# ---- rows 11-13: text column selection --------------------------------------------

@register("text_select_priority", """
select cast(p_partkey as varchar) sample_id, coalesce(p_name, '') text from part left join documents on p_partkey = doc_id""")
def q_text_select_priority(spark, sf):
    # candidates "name" and "description" are present; "name" has mean length > 0 and wins
    from ..sources.tables import read_table

    part = read_table(spark, sf, "part")
    docs = read_table(spark, sf, "documents").select(F.col("doc_id").alias("p_partkey"), "text")
    df = part.join(docs, "p_partkey", "left").select(
        F.col("p_partkey").cast("string").alias("sample_id"), F.col("p_name").alias("name"),
        F.col("text").alias("description"))
    return df.select("sample_id", S.select_text_priority(df).alias("text"))


@register("text_concat_fallback", with_catalog(select="""
select sample_id, concat_ws(' ', coalesce(catalog_content, ''), coalesce(image_link, ''), coalesce(p_brand, ''),
  coalesce(p_type, '')) text from catalog"""))
def q_text_concat_fallback(spark, sf):
    df = catalog(spark, sf).drop("embedding")
    return df.select("sample_id", S.select_text_priority(df).alias("text"))


@register("text_select_catalog", with_catalog(select="select sample_id, coalesce(catalog_content, '') text from catalog"))
def q_text_select_catalog(spark, sf):
    df = catalog(spark, sf)
    return df.select("sample_id", S.select_text_catalog(df).alias("text"))


# ---- rows 14-16: clean-up -------------------------------------------------------------

@register("text_normalize", with_catalog(select=f"select sample_id, {q.normalize('catalog_content')} text from catalog"))
def q_text_normalize(spark, sf):
    return catalog(spark, sf).select("sample_id", tx.normalize("catalog_content").alias("text"))


@register("unit_normalize", with_catalog(select=f"select sample_id, {q.preprocess('catalog_content')} text from catalog"))
def q_unit_normalize(spark, sf):
    return catalog(spark, sf).select("sample_id", tx.preprocess("catalog_content").alias("text"))


@register("accent_fold", with_catalog(select=f"select sample_id, {q.analyzer_text('catalog_content')} text from catalog"))
def q_accent_fold(spark, sf):
    return catalog(spark, sf).select("sample_id", tx.analyzer_text("catalog_content").alias("text"))


# ---- rows 17-20: tokens and n-grams, reported as term-frequency tables -----------------

def _tf(df: DataFrame, analyzer: T.Analyzer) -> DataFrame:
    """(sample_id, term, tf): counted inside each document (no shuffle for the
    count itself; see ``operators/tfidf.term_counts``)."""
    return T.term_counts(df, "catalog_content", analyzer)


def _corpus(df: DataFrame, analyzer: T.Analyzer) -> DataFrame:
    """(term, df, total): counted inside each document, added up in every task
    and then by term."""
    return T.corpus_stats(df, "catalog_content", analyzer).withColumnRenamed("tc", "total")


_TOK = q.word_tokens(q.analyzer_text("catalog_content"))


@register("word_tokens", with_catalog(select=f"""
select sample_id, term, count(*) tf from (select sample_id, unnest({_TOK}) term from catalog) group by all"""))
def q_word_tokens(spark, sf):
    return _tf(catalog(spark, sf), T.Analyzer("word", 1, 1))


@register("stopword_filter", with_catalog(select=f"""
select sample_id, term, count(*) tf from (select sample_id, unnest({q.remove_stop_words(_TOK)}) term from catalog)
group by all"""))
def q_stopword_filter(spark, sf):
    return _tf(catalog(spark, sf), T.Analyzer("word", 1, 1, stop_words=True))


_NG_T = q.remove_stop_words(_TOK)


@register("word_ngrams_1_2", with_catalog(f"t as (select sample_id, {_NG_T} w from catalog)", select="""
select term, count(*) df, sum(tf) total from (
  select sample_id, term, count(*) tf from (
    select sample_id, unnest(w) term from t
    union all
    select sample_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) term from t
  ) group by all) group by term"""))
def q_word_ngrams(spark, sf):
    return _corpus(catalog(spark, sf), T.Analyzer("word", 1, 2, stop_words=True))


def char_wb_sql(text_sql: str, n_min: int, n_max: int) -> str:
    """DuckDB twin of ``char_wb_ngrams``: one row per (sample_id, gram)."""
    arms = []
    for n in range(n_min, n_max + 1):
        cond = "L >= %d" % n
        arms.append(f"select sample_id, substr(w, i, {n}) term from (select *, unnest(range(1, L - {n} + 2)) i "
                    f"from ws where {cond})")
    arms.append(f"select sample_id, w term from ws where L < {n_min}")
    return (f"ws as (select sample_id, w, length(w) L from (select sample_id, ' ' || unnest({q.words(text_sql)}) || ' ' w "
            f"from catalog)),\ngrams as (" + "\nunion all\n".join(arms) + ")")


@register("char_wb_ngrams", with_catalog(char_wb_sql(q.analyzer_text("catalog_content"), 3, 4), select="""
select term, count(*) df, sum(tf) total from (select sample_id, term, count(*) tf from grams group by all)
group by term"""))
def q_char_wb(spark, sf):
    return _corpus(catalog(spark, sf), T.Analyzer("char_wb", 3, 4))


# ---- rows 21-25, 36: text statistics -------------------------------------------------------

def _stat_query(key: str, spark_fn, sql_fn):
    @register(key, with_catalog(select=f"select sample_id, round({sql_fn('catalog_content')}, 6) v from catalog"))
    def fn(spark, sf):
        return catalog(spark, sf).select("sample_id", r6(spark_fn("catalog_content").cast("double")).alias("v"))

    return fn


_stat_query("text_char_count", tx.char_count, q.char_count)
_stat_query("text_word_count", tx.word_count, q.word_count)
_stat_query("text_unique_char_ratio", tx.unique_char_ratio, q.unique_char_ratio)
_stat_query("text_punct_ratio", tx.punct_ratio, q.punct_ratio)
_stat_query("text_digit_ratio", tx.digit_ratio, q.digit_ratio)
_stat_query("text_sentence_count", tx.sentence_count, q.sentence_count)


@register("text_mean_length", with_catalog(select="""
select round(avg(length(catalog_content)), 6) mean_content, round(avg(length(image_link)), 6) mean_link,
  round(avg(length(p_name)), 6) mean_name from catalog join part on sample_id = cast(p_partkey as varchar)"""))
def q_text_mean_length(spark, sf):
    from ..sources.tables import read_table

    part = read_table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("sample_id"), "p_name")
    return catalog(spark, sf).join(part, "sample_id").agg(
        r6(F.avg(F.length("catalog_content"))).alias("mean_content"),
        r6(F.avg(F.length("image_link"))).alias("mean_link"),
        r6(F.avg(F.length("p_name"))).alias("mean_name"),
    )
