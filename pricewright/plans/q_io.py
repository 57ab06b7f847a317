"""Queries for sources, sinks, link lists and acquisition planning (rows 1-5, 9-10,
34-35, 42, 44, 57, 97-98).

File-based operators round-trip data Spark derives from the driver tables
through files in the shared scratch folder, so their work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import acquire as A
from ..operators import select as S
from ..operators.sinks import submission, write_submission
from ..sources import csv as C
from ..sources.links import faillog_source, url_filename, url_source
from ..sources.tables import catalog, read_table, train_test
from ..sources.visual import visual_features
from ..session import scratch_path
from .registry import r6, register, with_catalog


@register("csv_read_robust", with_catalog(select="""
select sample_id, catalog_content, image_link, round(price, 6) price from catalog"""))
def q_csv_read_robust(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "catalog-csv")
    C.write_csv(catalog(spark, sf).select("sample_id", "catalog_content", "image_link", "price"), path)
    df = C.read_csv(spark, path, C.TRAIN_SCHEMA)
    return df.select("sample_id", "catalog_content", "image_link", r6("price").alias("price"))


@register("csv_read_latin1", with_catalog(select=r"""
select sample_id, regexp_replace(catalog_content, '[^\x{00}-\x{FF}]', '?', 'g') catalog_content, round(price, 6) price
from catalog"""))
def q_csv_read_latin1(spark: SparkSession, sf: str) -> DataFrame:
    """The same round trip in ISO-8859-1; characters it lacks become ``?``."""
    path = scratch_path(spark, "catalog-latin1")
    C.write_csv(catalog(spark, sf).select("sample_id", "catalog_content", "image_link", "price"), path, "ISO-8859-1")
    df = C.read_csv(spark, path, C.TRAIN_SCHEMA, "ISO-8859-1")
    return df.select("sample_id", "catalog_content", r6("price").alias("price"))


@register("csv_quarantine", with_catalog(select="""
select sample_id, has_visual = 0 bad, case when has_visual = 1 then round(price, 6) end price from catalog"""))
def q_csv_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    # items without a visual vector get a price written as "<n> USD": unparsable
    cat = catalog(spark, sf)
    price_txt = F.when(F.col("has_visual") == 1, F.col("price").cast("string")).otherwise(
        F.concat(F.col("price").cast("string"), F.lit(" USD")))
    path = scratch_path(spark, "quarantine-csv")
    C.write_csv(cat.select("sample_id", "catalog_content", "image_link", price_txt.alias("price")), path)
    q = C.read_quarantine(spark, path, C.TRAIN_SCHEMA)
    return q.select("sample_id", "bad", r6("price").alias("price"))


@register("require_columns", with_catalog(select="select sample_id, round(price, 6) price from catalog"))
def q_require_columns(spark, sf):
    df = S.require_columns(catalog(spark, sf), ["sample_id", "price", "image_link"])
    return df.select("sample_id", r6("price").alias("price"))


@register("visual_feature_source", "select cast(vec_id as varchar) sample_id, embedding features from embeddings")
def q_visual_source(spark, sf):
    return visual_features(read_table(spark, sf, "embeddings"), id_col="vec_id", vec_col="embedding")


_BRAND_PRED = with_catalog(
    "m as (select p_brand, avg(price) pred from catalog where fold <> 0 group by p_brand)",
    select="""select sample_id, round(greatest(pred, 0.01), 6) price
from catalog join m using (p_brand) where fold = 0""")


def _brand_predictions(spark, sf) -> DataFrame:
    train, test = train_test(catalog(spark, sf))
    m = train.groupBy("p_brand").agg(F.avg("price").alias("prediction"))
    return test.join(m, "p_brand").select("sample_id", "prediction")


@register("submission_sink", _BRAND_PRED)
def q_submission_sink(spark, sf):
    path = scratch_path(spark, "submission")
    write_submission(_brand_predictions(spark, sf), path)
    back = C.read_csv(spark, path, "sample_id string, price double")
    return back.select("sample_id", r6("price").alias("price"))


@register("output_project", _BRAND_PRED)
def q_output_project(spark, sf):
    return submission(_brand_predictions(spark, sf)).select("sample_id", r6("price").alias("price"))


@register("url_source", "select url image_link from pages where url is not null")
def q_url_source(spark, sf):
    path = scratch_path(spark, "links-csv")
    C.write_csv(read_table(spark, sf, "pages").select("page_id", "url"), path)
    return url_source(C.read_csv(spark, path, "page_id long, url string"), "url")


@register("faillog_source", "select trim(url) image_link from pages where trim(url) <> ''")
def q_faillog_source(spark, sf):
    path = scratch_path(spark, "faillog")
    # one padded link per line, each followed by a blank line
    lines = read_table(spark, sf, "pages").select(F.concat(F.lit("  "), "url", F.lit(" \n")).alias("value"))
    lines.write.mode("overwrite").text(path)
    return faillog_source(spark, path)


@register("url_to_filename", "select page_id, regexp_extract(url, '([^/]+)/*$', 1) filename from pages")
def q_url_to_filename(spark, sf):
    return read_table(spark, sf, "pages").select("page_id", url_filename("url").alias("filename"))


# Stand-in for the folder listing of stored images: files of https links.
def _manifest(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("url").startswith("https")).select(url_filename("url").alias("filename"))


_MANIFEST_SQL = "mf as (select distinct regexp_extract(url, '([^/]+)/*$', 1) filename from pages where starts_with(url, 'https'))"
_LINKS_SQL = "lk as (select url image_link, regexp_extract(url, '([^/]+)/*$', 1) filename from pages where url is not null)"


@register("fetch_worklist", f"""with {_MANIFEST_SQL}, {_LINKS_SQL}
select filename, min(image_link) image_link from lk where filename not in (select filename from mf) group by filename""")
def q_fetch_worklist(spark, sf):
    pages = read_table(spark, sf, "pages")
    return A.worklist(pages.select(F.col("url").alias("image_link")), _manifest(pages))


@register("fetch_failures", f"""with {_MANIFEST_SQL}, {_LINKS_SQL}
select image_link, lk.filename, case when mf.filename is null then 'missing' else 'fetched' end status
from lk left join mf on lk.filename = mf.filename""")
def q_fetch_failures(spark, sf):
    pages = read_table(spark, sf, "pages")
    return A.fetch_status(pages.select(F.col("url").alias("image_link")), _manifest(pages))


@register("link_counts", f"""with {_MANIFEST_SQL},
lk as (select url image_link, regexp_extract(url, '([^/]+)/*$', 1) filename from pages)
select count(image_link) usable, sum(case when image_link is null then 1 else 0 end) null_links,
  sum(case when image_link is not null and mf.filename is not null then 1 else 0 end) fetched,
  sum(case when image_link is not null and mf.filename is null then 1 else 0 end) to_retry
from lk left join mf on lk.filename = mf.filename""")
def q_link_counts(spark, sf):
    pages = read_table(spark, sf, "pages")
    return A.link_counts(pages.select(F.col("url").alias("image_link")), _manifest(pages))


@register("worklist_limit", "select page_id, url image_link from pages order by page_id limit 100")
def q_worklist_limit(spark, sf):
    pages = read_table(spark, sf, "pages").select("page_id", F.col("url").alias("image_link"))
    return A.limit_links(pages, 100, "page_id")


# ---- row 44: submission completeness --------------------------------------------------

def completeness(expected: DataFrame, predicted: DataFrame) -> DataFrame:
    """Counts of missing, extra, duplicated and non-positive predictions.

    Per-id counts first (partial aggregation), then one full outer join on id
    and a single global aggregate."""
    per_id = predicted.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_pred"),
        F.sum(F.when(F.col("price") <= 0, 1).otherwise(0)).alias("n_nonpos"))
    exp = expected.select("sample_id").distinct().withColumn("_exp", F.lit(1))
    j = exp.join(per_id, "sample_id", "full_outer")
    return j.agg(
        F.sum(F.when(F.col("_exp").isNotNull() & F.col("n_pred").isNull(), 1).otherwise(0)).alias("missing"),
        F.sum(F.when(F.col("_exp").isNull(), 1).otherwise(0)).alias("extra"),
        F.sum(F.when(F.col("n_pred") > 1, 1).otherwise(0)).alias("duplicated"),
        F.coalesce(F.sum("n_nonpos"), F.lit(0)).alias("non_positive"),
        F.sum(F.when(F.col("_exp").isNotNull() & (F.col("n_pred") == 1) & (F.col("n_nonpos") == 0), 1)
              .otherwise(0)).alias("valid"),
    )


def _doc_predictions(spark, sf) -> DataFrame:
    docs = read_table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("sample_id"), (F.col("n_chars") / 100.0 - 5).alias("price"))
    labels = read_table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("sample_id"), (F.col("quality") * 10.0 + 1).alias("price"))
    return docs.unionByName(labels)


@register("submission_completeness", with_catalog(
    "e as (select distinct sample_id, 1 _exp from catalog where fold = 0)",
    """p as (select sample_id, count(*) n_pred, sum(case when price <= 0 then 1 else 0 end) n_nonpos from (
  select cast(doc_id as varchar) sample_id, n_chars / 100.0 - 5 price from documents
  union all select cast(doc_id as varchar), quality * 10.0 + 1 from labels) group by sample_id)""",
    select="""select sum(case when _exp is not null and n_pred is null then 1 else 0 end) missing,
  sum(case when _exp is null then 1 else 0 end) extra, sum(case when n_pred > 1 then 1 else 0 end) duplicated,
  coalesce(sum(n_nonpos), 0) non_positive,
  sum(case when _exp is not null and n_pred = 1 and n_nonpos = 0 then 1 else 0 end) valid
from e full outer join p using (sample_id)"""))
def q_submission_completeness(spark, sf):
    _, test = train_test(catalog(spark, sf))
    return completeness(test, _doc_predictions(spark, sf))
