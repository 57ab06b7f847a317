"""The queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracles
from .chat import chat_digest
from .common import table
from .decontam import contamination_digest
from .langid import langid_digest
from .mixing import mix_digest
from .neardup import duplicate_digest
from .quality import quality_digest
from .resample import resample_digest
from .secret_scan import secret_digest
from .sharding import shard_digest
from .syncmers import fingerprint_digest
from .tokencount import token_digest
from .toxicity import toxicity_digest
from .whitening import whitening_digest

QueryFn = Callable[[SparkSession, str], DataFrame]


def on_documents(digest: Callable[[DataFrame], DataFrame]) -> QueryFn:
    return lambda spark, sf_dir: digest(table(spark, sf_dir, "documents"))


def on_labelled(digest: Callable[[DataFrame, DataFrame], DataFrame]) -> QueryFn:
    return lambda spark, sf_dir: digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, QueryFn] = {
    "op1_language_id": on_documents(langid_digest),
    "op2_decontamination": lambda spark, sf_dir: contamination_digest(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op3_token_counts": on_documents(token_digest),
    "op4_fingerprints": on_documents(fingerprint_digest),
    "op5_near_duplicates": on_documents(duplicate_digest),
    "op6_secret_scan": on_documents(secret_digest),
    "op7_toxicity": on_labelled(toxicity_digest),
    "op8_mixing": on_documents(mix_digest),
    "op9_quality": on_labelled(quality_digest),
    "op10_sharding": on_documents(shard_digest),
    "op11_resampling": lambda spark, sf_dir: resample_digest(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op12_whitening": lambda spark, sf_dir: whitening_digest(table(spark, sf_dir, "embeddings")),
    "op13_chat": lambda spark, sf_dir: chat_digest(table(spark, sf_dir, "conversations")),
}

ORACLE: dict[str, str] = {
    "op2_decontamination": oracles.DECONTAMINATION,
    "op8_mixing": oracles.MIXING,
    "op10_sharding": oracles.SHARDING,
    "op11_resampling": oracles.RESAMPLING,
    "op13_chat": oracles.CHAT,
}
