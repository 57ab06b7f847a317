"""The registered model queries fit the library's default members and counts."""

from unittest.mock import MagicMock

import pytest
from pricewright.operators import regress as R
from pricewright.plans import pipelines as PL
from pricewright.plans import q_models as Q


@pytest.mark.parametrize("query, rounds, loss", [(Q.q_gbt_squared, 800, "squared"), (Q.q_gbt_absolute, 1000, "absolute")])
def test_boosted_queries_boost_all_rounds(spark, monkeypatch, query, rounds, loss):
    fitted = []
    monkeypatch.setattr(Q, "_fit_test", lambda s, sf, est: fitted.append(est))
    query(spark, "")
    assert [(e.spec.trees, e.spec.loss) for e in fitted] == [(rounds, loss)]


def test_registry_fits_all_counts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(PL, "prepare", lambda *a: (None, None, None))
    monkeypatch.setattr(Q.E, "oof_predictions", lambda a, models, **k: seen.append(models))
    monkeypatch.setattr(Q.E, "oof_scores", lambda oof: MagicMock())
    Q.q_base_model_registry(MagicMock(), "")
    boosted = {n: m.spec.trees for n, m in seen[0].items() if n.startswith("gbt")}
    assert boosted == {"gbt_leafwise": 1000, "gbt_depth6": 800, "gbt_absolute": 1000}


@pytest.mark.parametrize("query", [Q.q_stacker_select, Q.q_stack_fit_predict, Q.q_run_metadata])
def test_stacked_queries_run_all_members(spark, monkeypatch, query):
    seen = []
    res = {"meta": {"stackers_skipped": {}, "stacker": "ridge"}, "stacker_oof": None, "submission": MagicMock()}
    monkeypatch.setattr(PL, "run_stacked", lambda s, sf, cfg=None, out=None: seen.append(cfg) or res)
    monkeypatch.setattr(Q, "scratch_path", lambda s, name: name)
    monkeypatch.setattr(Q.E, "oof_scores", lambda oof: spark.createDataFrame([("ridge", 1.0)], "model string, smape double"))
    query(MagicMock() if query is Q.q_run_metadata else spark, "")
    cfg = seen[0]
    assert cfg.models is None and cfg.gbt_rounds is None and cfg.rf_trees is None and cfg.tree_scale == 1.0
    assert R.stacker_models(cfg.tree_scale, cfg.gbt_rounds)["gbt"].spec.trees == 500
