"""Corpus pipeline: from raw documents to training shards.

Every stage takes (spark, docs, sf_dir), works on all documents that its
predecessor kept, and returns a DataFrame; each result is written as Parquet to
the shared folder and read again, so a lost executor never repeats a stage.

Edge cases: stages take null texts, ids and sources, repeated rows and empty
tables as their operators define them; null texts have no letter, so language
ID rejects them.  Further columns of any name keep their values, but for those
named like the last stage's results (size, shard, slot), which are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.llm import decontam, langid, mixing, neardup, sharding
from pricewright.llm.common import table
from pricewright.session import free_shuffles, scratch_path

SHARDS = 8
#: What the stages read; all other columns travel as one value.
READ = ("doc_id", "text", "lang", "source", "n_chars")


def carried(stage):
    """The stage with the documents' further columns packed into one, so that no
    name of theirs can clash with a helper's; they come out as they went in."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str, **kw) -> DataFrame:
        more = [c for c in docs.columns if c not in READ]
        if not more:
            return stage(spark, docs, sf_dir, **kw)
        name = "more"
        while name.lower() in (c.lower() for c in docs.columns):
            name += "_"
        own = [c for c in docs.columns if c in READ]
        out = stage(spark, docs.select(*own, F.struct(*[F.col(f"`{c}`") for c in more]).alias(name)), sf_dir, **kw)
        added = [c for c in out.columns if c not in own and c != name]
        taken = {c.lower() for c in added}  # results replace columns of their names
        return out.select(*[F.col(c) if c in own else F.col(name).getField(c).alias(c) for c in docs.columns if c.lower() not in taken],
                          *added)

    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


@carried
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str, wanted: tuple[str, ...] | None = None,
                      more_than: float = 0.5) -> DataFrame:
    """Keeps the documents whose predicted language is wanted (by default: any
    that was learned) and more likely than all others together.  The model
    learns from all labelled rows.  Texts without a letter have no language.
    Where no row has a language none can be told, and only those are rejected."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    model = langid.fit(docs)
    if not model.langs:
        kept = row.filter(langid.lettered(F.col("text").cast("string")))
    else:
        kept = langid.identify(row, model).filter(F.col("__lang").isin(*(wanted or model.langs)) & (
            (F.col("__score") > more_than) | F.lit(len(model.langs) == 1)))
        kept = kept.filter(F.col("__lang") != "und")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


@carried
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group (five-word shingles, similarity 0.8)."""
    return neardup.one_of_each(docs, words=5, percent=80)


@carried
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the contamination rule names."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


@carried
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits each document as often as its source's repetition rate asks for."""
    return mixing.mix(docs)


@carried
def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds size, shard and slot."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        free_shuffles(spark)  # a stage's models, broadcasts and shuffle files end with it
    return docs
