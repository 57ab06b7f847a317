"""The registry's failing members, and a stored run that is loaded again."""

import pytest
from conftest import SF_SMALL
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from pricewright.operators import ensemble as E
from pricewright.operators.regress import Ridge
from pricewright.plans import pipelines as PL


class Broken(Ridge):
    def _fit(self, df):
        raise ValueError("this member cannot be fitted")


@pytest.fixture(scope="module")
def rows(spark):
    data = [(str(i), i % 5, float(i % 7), float(i % 7) * 3 + 10) for i in range(60)]
    df = spark.createDataFrame(data, "sample_id string, cv_fold int, x double, price double")
    return df.withColumn("fv", array_to_vector(F.array("x")))


def test_a_failing_member_is_reported_and_skipped(rows):
    skipped: dict[str, str] = {}
    oof = E.oof_predictions(rows, {"ridge": Ridge(), "broken": Broken()}, skipped=skipped)
    assert {r["model"] for r in oof.select("model").distinct().collect()} == {"ridge"} and oof.count() == 60
    assert list(skipped) == ["broken"] and "cannot be fitted" in skipped["broken"]
    with pytest.raises(ValueError):
        E.oof_predictions(rows, {"ridge": Ridge(), "broken": Broken()})


def test_no_member_left_is_an_error(rows):
    with pytest.raises(RuntimeError, match="no model could be fitted"):
        E.oof_predictions(rows, {"broken": Broken()}, skipped={})


def test_stored_run(spark, tmp_path):
    """Submission, metadata and models of a real run are written; the loaded
    models predict what the fitted ones do."""
    small = PL.FeatureConfig(svd_k=5, svd_iter=1)
    cfg = PL.RunConfig(models=("ridge", "elastic_net"), gbt_rounds=3, features=small)
    out = f"file://{tmp_path}/run"
    res = PL.run_stacked(spark, SF_SMALL, cfg, out=out)
    meta = spark.read.json(f"{out}/metadata").first().asDict(recursive=True)
    assert meta["base_models"] == ["ridge", "elastic_net"] and set(meta["cv_scores"]) == {"ridge", "elastic_net"}
    assert meta["n_features"] == res["meta"]["n_features"]
    assert spark.read.option("header", "true").csv(f"{out}/submission").count() == res["test"].count()
    for name, model in res["fitted"].items():
        loaded = LinearRegressionModel.load(f"{out}/models/{name}")
        a = {r["sample_id"]: r["prediction"] for r in model.transform(res["test"]).collect()}
        b = {r["sample_id"]: r["prediction"] for r in loaded.transform(res["test"]).collect()}
        assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-9
    # the whole pipeline, loaded again, scores raw items as the run did
    from pyspark.ml import PipelineModel

    from pricewright.sources.tables import catalog, train_test
    _, items = train_test(catalog(spark, SF_SMALL))
    raw = items.select("sample_id", "catalog_content", "image_link", "p_brand", "p_type", "p_size", "n_chars", F.col("embedding").alias("features"))
    for pipe in (res["pipeline"], PipelineModel.load(f"{out}/pipeline")):
        got = {r["sample_id"]: r["price"] for r in pipe.transform(raw).collect()}
        want = {r["sample_id"]: r["price"] for r in res["submission"].collect()}
        assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9
    # every item of train and test went through the whole matrix
    assert res["train"].count() + res["test"].count() == 200
    widths = {len(r["fv"]) for r in res["train"].select("fv").collect()}
    assert widths == {res["meta"]["n_features"]}


def test_empty_vocabulary_is_an_empty_block(spark):
    from pricewright.operators import decompose

    x = spark.createDataFrame([], "sample_id string, term string, weight double")
    model = decompose.fit_truncated_svd(x, x.select("term"), 4)
    assert model.components.shape == (0, 0) and model.transform(x).count() == 0
