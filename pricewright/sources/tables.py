"""Driver tables and the ``catalog`` view built from them.

The reference trains on ``sample_id, catalog_content, image_link, price``.  The
driver data has no such table, so ``catalog`` derives one from ``part``,
``documents`` and ``embeddings`` (FIXTURES.md §3): every catalogue operator
reads it, so its work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import md5_bits32, uniform01
from ..session import table_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue items with text, image link, planted price, visual vector, fold.

    Two left joins on the part key.  At scale all three inputs are large and
    keyed the same way, so Spark plans sort-merge joins sharing one hash
    partitioning on the key (no skew: keys are unique per side).
    """
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"
    )
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("p_partkey"), "text", "n_chars"
    )
    vis = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("p_partkey"), "embedding"
    )
    k = F.col("p_partkey")
    u = uniform01(k)
    fold = (md5_bits32(k) % 5).cast("int")
    n_chars = F.coalesce(F.col("n_chars"), F.lit(0)).cast("double")
    return (
        part.join(docs, "p_partkey", "left")
        .join(vis, "p_partkey", "left")
        .select(
            k.cast("string").alias("sample_id"),
            F.concat(
                "p_name", F.lit(" "), "p_brand", F.lit(" "), "p_type", F.lit(" "),
                F.col("p_size").cast("string"), F.lit(" Ounces, pack of "),
                (F.col("p_size") % 12 + 1).cast("string"), F.lit(" "),
                F.coalesce(F.col("text"), F.lit("")),
            ).alias("catalog_content"),
            F.concat(F.lit("http://img.example.com/I/"), k.cast("string"), F.lit(".jpg")).alias("image_link"),
            "p_brand", "p_type", "p_size",
            n_chars.alias("n_chars"),
            F.col("p_retailprice").alias("price_raw"),
            (F.lit(5.0) + F.lit(0.8) * F.col("p_size") + F.lit(0.002) * n_chars + F.lit(10.0) * u).alias("price"),
            "embedding",
            F.when(F.col("embedding").isNull(), 0.0).otherwise(1.0).alias("has_visual"),
            fold.alias("fold"),
        )
    )


# DuckDB form of the same view, used as a CTE by the oracle SQL (FIXTURES.md §3).
CATALOG_SQL = """
catalog as (
 with k as (select *, ('0x'||substr(md5(cast(p_partkey as varchar)),1,8))::bigint::double/4294967296e0 u,
                  (('0x'||substr(md5(cast(p_partkey as varchar)),1,8))::bigint%5)::int fold from part)
 select cast(p_partkey as varchar) sample_id,
  concat(p_name,' ',p_brand,' ',p_type,' ',cast(p_size as varchar),' Ounces, pack of ',cast(p_size % 12 + 1 as varchar),' ',coalesce(text,'')) catalog_content,
  concat('http://img.example.com/I/',cast(p_partkey as varchar),'.jpg') image_link, p_brand, p_type, p_size,
  cast(coalesce(n_chars,0) as double) n_chars,
  p_retailprice price_raw, 5 + 0.8e0*p_size + 0.002e0*coalesce(n_chars,0) + 10*u price, embedding,
  case when embedding is null then 0.0e0 else 1.0e0 end has_visual, fold
 from k left join documents on p_partkey=doc_id left join embeddings on p_partkey=vec_id
)"""


def train_test(cat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train = fold <> 0, test = fold = 0 (test keeps its price for scoring)."""
    return cat.filter(F.col("fold") != 0), cat.filter(F.col("fold") == 0)
