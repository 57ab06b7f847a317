"""Gram solvers against dense ones; all folds and penalties from one pass."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegressionModel

from pricewright.operators import ensemble as E
from pricewright.operators import linear as L
from pricewright.operators.regress import ElasticNet, Ridge, base_models


def data(n=300, d=12, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + 3
    y = x[:, 0] - 2 * x[:, 3] + rng.normal(size=n) + 40
    return x, y


def gram(x, y):
    z = np.column_stack([np.ones(len(x)), x, y])
    return L.Gram.of(z.T @ z)


def frame(spark, x, y):
    rows = [(str(i), float(y[i]), i % 5, [float(v) for v in x[i]]) for i in range(len(y))]
    df = spark.createDataFrame(rows, "sample_id string, price double, cv_fold int, a array<double>")
    return df.withColumn("fv", array_to_vector("a")).drop("a").repartition(4)


def test_ridge():
    x, y = data()
    w, b = L.solve_ridge(gram(x, y), 2.5)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 2.5 * np.eye(12), xc.T @ yc)
    assert np.abs(w - want).max() < 1e-9 and abs(b - (y.mean() - x.mean(0) @ want)) < 1e-8


@pytest.mark.parametrize("alpha,ratio", [(1e-4, 0.05), (1e-4, 0.5), (0.5, 0.7), (0.5, 1.0), (0.5, 0.0), (1e3, 0.9)])
def test_elastic_net_is_optimal(alpha, ratio):
    """No step in any direction lowers the objective, and a plain proximal
    gradient method ends at the same point."""
    x, y = data()
    g = gram(x, y)
    w, _ = L.solve_elastic_net(g, alpha, ratio)
    xc, yc, n = x - x.mean(0), y - y.mean(), len(y)
    l1, l2 = alpha * ratio, alpha * (1 - ratio)
    v, step = np.zeros(12), 1 / (np.linalg.eigvalsh(xc.T @ xc / n)[-1] + l2)
    z, t = v.copy(), 1.0
    for _ in range(60_000):
        u = z - step * (xc.T @ (xc @ z - yc) / n + l2 * z)
        new = np.sign(u) * np.maximum(np.abs(u) - step * l1, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, v, t = new + (t - 1) / t2 * (new - v), new, t2
    assert np.abs(w - v).max() < 1e-6


@pytest.mark.parametrize("ratio", [0.05, 0.5])
def test_elastic_net_on_nearly_dependent_columns(ratio):
    """Sweeps over the columns alone crawl here."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 8)) @ rng.normal(size=(8, 60)) + 1e-3 * rng.normal(size=(400, 60))
    y = x @ rng.normal(size=60) + 5 * rng.normal(size=400)
    g = gram(x, y)
    w, _ = L.solve_elastic_net(g, 1e-4, ratio)
    l1, l2 = 1e-4 * ratio * g.n, 1e-4 * (1 - ratio) * g.n
    slope, on = g.xy - g.xx @ w - l2 * w, w != 0
    assert np.abs(slope - l1 * np.sign(w))[on].max() < 1e-8 * np.abs(g.xy).max()
    assert (np.abs(slope)[~on] <= l1 * (1 + 1e-8) + 1e-9 * np.abs(g.xy).max()).all()


def test_dependent_columns():
    x, y = data(d=4)
    x = np.column_stack([x, x[:, 0], np.full(len(x), 7.0)])
    w, b = L.solve_elastic_net(gram(x, y), 0.1, 0.5)
    assert np.isfinite(w).all() and w[-1] == 0
    w, b = L.solve_ridge(gram(x, y), 0.0)
    assert np.isfinite(w).all()


def test_search_equals_single_fits(spark):
    x, y = data()
    df = frame(spark, x, y)
    _, got = E.tune(ElasticNet(alpha=0.05), ElasticNet.l1Ratio, [0.1, 0.9], df)
    fold = np.arange(len(y)) % 5
    for ratio, score in got:
        each = []
        for f in range(5):
            w, b = L.solve_elastic_net(gram(x[fold != f], y[fold != f]), 0.05, ratio)
            p, t = x[fold == f] @ w + b, y[fold == f]
            each.append(100 * np.mean(2 * np.abs(p - t) / (np.abs(p) + np.abs(t))))
        assert abs(score - np.mean(each)) < 1e-9


def test_members_of_all_kinds_out_of_fold(spark, tmp_path):
    """Linear and tree members fitted together predict what single fits do, and load again."""
    from pricewright.operators.trees import TreeEnsembleModel

    x, y = data(d=5)
    df = frame(spark, x, y)
    models = base_models(rf_trees=3, gbt_rounds=3)
    oof = E.oof_predictions(df, models)
    assert oof.count() == 6 * len(y) and oof.select("sample_id", "model").distinct().count() == 6 * len(y)
    for name in ("ridge", "elastic_net", "gbt_depth6"):
        rest, held = df.filter("cv_fold <> 2"), df.filter("cv_fold = 2")
        fitted = models[name].fit(rest)
        one = {r["sample_id"]: r["prediction"] for r in fitted.transform(held).collect()}
        mine = {r["sample_id"]: r["prediction"] for r in oof.filter(f"model = '{name}' and fold = 2").collect()}
        # the joint table's bins come from all rows, the single one's from its own
        assert one.keys() == mine.keys() and max(abs(one[k] - mine[k]) for k in one) < (1e-9 if name != "gbt_depth6" else 20)
        path = f"file://{tmp_path}/{name}"
        fitted.write().overwrite().save(path)
        loaded = (TreeEnsembleModel if name == "gbt_depth6" else LinearRegressionModel).load(path)
        again = {r["sample_id"]: r["prediction"] for r in loaded.transform(held).collect()}
        assert max(abs(again[k] - one[k]) for k in one) < 1e-12


def test_a_member_that_fails_while_predicting_is_skipped(spark):
    from pyspark.sql import functions as F

    class Late(Ridge):
        def _fit(self, df):
            fail = F.udf(lambda v: 1 / 0, "double")

            class Model:
                def transform(self, rows):
                    return rows.withColumn("prediction", fail("price"))

            return Model()

    x, y = data(n=50, d=5)
    skipped = {}
    oof = E.oof_predictions(frame(spark, x, y), {"ridge": Ridge(), "late": Late()}, skipped=skipped)
    assert {r["model"] for r in oof.select("model").distinct().collect()} == {"ridge"} and list(skipped) == ["late"]
