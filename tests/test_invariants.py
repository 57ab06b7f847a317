"""Partitioning does not change results; out-of-fold rows are complete."""

import pytest
from oracle import rows_of

from __spark_entry__ import queries
from conftest import SF_SMALL

KEYS = ["brand_baseline", "word_tfidf", "robust_scale", "fetch_worklist", "submission_completeness",
        "oof_predictions", "term_document_frequency"]


@pytest.mark.parametrize("key", KEYS)
def test_repartition_invariance(spark, key):
    out = {}
    for n in (1, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = queries()[key](spark, SF_SMALL)
        out[n] = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[1] == out[16]


def test_oof_complete(spark):
    from pricewright.operators import ensemble as E
    from pricewright.operators import regress as R
    from pricewright.plans.q_models import _one_feature
    from pyspark.sql import functions as F

    tr, _ = _one_feature(spark, SF_SMALL, "n_chars")
    oof = E.oof_predictions(tr, {"ridge": R.Ridge(alpha=1.0)})
    n, d = oof.agg(F.count("*"), F.count_distinct("sample_id")).first()
    assert n == d == tr.count()
