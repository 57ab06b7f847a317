"""The file-stream scorer gives the same prices as batch scoring."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricewright.operators import regress as R
from pricewright.session import scratch_path
from pricewright.sources import csv as C
from pricewright.sources.tables import catalog, train_test
from pricewright.streaming.score_stream import start_scoring


def test_stream_scoring_matches_batch(spark):
    train, test = train_test(catalog(spark, SF_SMALL))
    va = VectorAssembler(inputCols=["n_chars"], outputCol="fv")
    model = PipelineModel([va, R.Ridge(alpha=1.0).fit(va.transform(train))])
    mpath = scratch_path(spark, "stream-model")
    model.write().overwrite().save(mpath)
    in_dir, out_dir = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    C.write_csv(test.select("sample_id", "n_chars"), in_dir)
    q = start_scoring(spark, mpath, in_dir, out_dir, "sample_id string, n_chars double")
    q.awaitTermination(300)
    got = {r["sample_id"]: r["price"] for r in C.read_csv(spark, out_dir, "sample_id string, price double").collect()}
    want = {r["sample_id"]: max(r["prediction"], 0.01) for r in model.transform(test).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
