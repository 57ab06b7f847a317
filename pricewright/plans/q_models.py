"""Queries for regressors, evaluation, tuning, OOF and ensembles (rows 6-8, 43,
56, 58, 64, 67-68, 71-90, 99-102).

Closed-form oracles (SURVEY §5 c): a one-feature ridge is
slope = (Σxy − ΣxΣy/n) / (Σxx − (Σx)²/n + α), intercept = ȳ − slope·x̄; its
out-of-fold version uses the totals minus the fold's totals.  The one-feature
elastic net is sign(c)·max(|c| − α·r, 0) / (v + α(1 − r)) with c, v the
population covariance and variance.  Model predictions are reported rounded
to 3 decimals on both sides (iterative solvers agree to ~1e-9).
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import decompose
from ..operators import ensemble as E
from ..operators import metrics as M
from ..operators import regress as R
from ..operators import sparse_linear as SL
from ..operators.folds import with_folds
from ..operators.visual import VisualBlock, visual_dim, visual_join
from ..session import scratch_path
from ..sources import csv as C
from ..sources.tables import catalog, read_table, train_test
from ..sources.visual import visual_features
from . import pipelines as PL
from . import sqlfrag as q
from .features import FeatureConfig, build_features, text_blocks, text_column
from .registry import r6, register, with_catalog

# All counts are the reference's.
CHECK = PL.RunConfig()


def r3(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 3)


# ---- closed-form SQL ------------------------------------------------------------------------------

_CV = q.balanced_fold("sample_id", 5, 42)  # over the rows that the query selects


def ridge_fit_sql(x: str, alpha: float, name: str = "c") -> str:
    """CTE ``name``(b, a): one-feature ridge on the train rows."""
    return (f"{name} as (select b, sy / n - b * sx / n a from (select *, (sxy - sx * sy / n) / "
            f"(sxx - sx * sx / n + {alpha}) b from (select count(*)::double n, sum({x}) sx, sum(price) sy, "
            f"sum({x} * {x}) sxx, sum({x} * price) sxy from catalog where fold <> 0)))")


def ridge_oof_sql(x: str, alpha: float, name: str) -> list[str]:
    """CTEs giving ``name``(sample_id, cv, prediction, price) for train rows."""
    t = f"{name}_t"
    return [
        f"{t} as (select sample_id, {x} x, price, {_CV} cv from catalog where fold <> 0)",
        f"{name}_f as (select cv, count(*)::double n, sum(x) sx, sum(price) sy, sum(x * x) sxx, sum(x * price) sxy "
        f"from {t} group by cv)",
        f"{name}_c as (select f.cv, (tot.sxy - f.sxy - (tot.sx - f.sx) * (tot.sy - f.sy) / (tot.n - f.n)) / "
        f"(tot.sxx - f.sxx - (tot.sx - f.sx) * (tot.sx - f.sx) / (tot.n - f.n) + {alpha}) b, "
        f"tot.sx - f.sx sx, tot.sy - f.sy sy, tot.n - f.n n from {name}_f f, "
        f"(select sum(n) n, sum(sx) sx, sum(sy) sy, sum(sxx) sxx, sum(sxy) sxy from {name}_f) tot)",
        f"{name} as (select sample_id, cv, sy / n - b * sx / n + b * x prediction, price from {t} join {name}_c "
        f"using (cv))",
    ]


def _one_feature(spark, sf, x: str):
    train, test = train_test(catalog(spark, sf))
    train = with_folds(train, 5, 42)

    def vec(df):
        return df.withColumn("fv", array_to_vector(F.array(F.col(x).cast("double"))))

    return vec(train), vec(test)


# ---- rows 72-73: linear models with closed forms ---------------------------------------------------

@register("ridge", with_catalog(ridge_fit_sql("n_chars", 1.0), select="""
select sample_id, round(a + b * n_chars, 3) prediction from catalog, c where fold = 0"""))
def q_ridge(spark, sf):
    tr, te = _one_feature(spark, sf, "n_chars")
    return R.Ridge(alpha=1.0).fit(tr).transform(te).select("sample_id", r3("prediction").alias("prediction"))


@register("elastic_net", with_catalog(
    """e as (select case when cv > 0 then 1 else -1 end * greatest(abs(cv) - 0.5 * 0.7, 0) / (vx + 0.5 * 0.3) b,
  mx, my from (select covar_pop(n_chars, price) cv, var_pop(n_chars) vx, avg(n_chars) mx, avg(price) my
  from catalog where fold <> 0))""",
    select="select sample_id, round(my - b * mx + b * n_chars, 3) prediction from catalog, e where fold = 0"))
def q_elastic_net(spark, sf):
    tr, te = _one_feature(spark, sf, "n_chars")
    m = R.ElasticNet(alpha=0.5, l1Ratio=0.7, maxIter=2000).fit(tr)
    return m.transform(te).select("sample_id", r3("prediction").alias("prediction"))


# ---- rows 79-82, 56: evaluator, CV, searches -----------------------------------------------------

def _brand_preds(spark, sf) -> DataFrame:
    train, test = train_test(catalog(spark, sf))
    m = train.groupBy("p_brand").agg(F.avg("price").alias("prediction"))
    return test.join(m, "p_brand").select("sample_id", "price", "prediction")


_BRAND_SQL = ("bp as (select sample_id, price, pred from catalog join (select p_brand, avg(price) pred from catalog "
              "where fold <> 0 group by p_brand) using (p_brand) where fold = 0)")


@register("smape_evaluator", with_catalog(_BRAND_SQL, select=f"select round({q.smape('pred', 'price')}, 6) smape from bp"))
def q_smape_evaluator(spark, sf):
    v = R.SmapeEvaluator().evaluate(_brand_preds(spark, sf))
    return spark.range(1).select(F.round(F.lit(v), 6).alias("smape"))


@register("pluggable_metric", with_catalog(_BRAND_SQL, select="select round(avg(abs(pred - price)), 6) mae from bp"))
def q_pluggable_metric(spark, sf):
    v = R.ColumnMetric(M.mae("prediction", "price")).evaluate(_brand_preds(spark, sf))
    return spark.range(1).select(F.round(F.lit(v), 6).alias("mae"))


def _cv_sql(alphas: list[float]) -> str:
    arms = []
    for i, a in enumerate(alphas):
        ctes = ridge_oof_sql("n_chars", a, f"o{i}")
        arms.append((ctes, f"select {i} i, avg(s) cv_smape from (select cv, {q.smape('prediction', 'price')} s "
                           f"from o{i} group by cv)"))
    ctes = [c for a in arms for c in a[0]]
    body = " union all ".join(a[1] for a in arms)
    return with_catalog(*ctes, f"r as ({body})", select="select i, round(cv_smape, 4) cv_smape from r")


@register("cross_val_smape", _cv_sql([1.0]))
def q_cross_val_smape(spark, sf):
    tr, _ = _one_feature(spark, sf, "n_chars")
    _, scores = E.tune(R.Ridge(), R.Ridge.alpha, [1.0], tr)
    return spark.createDataFrame([(0, round(scores[0][1], 4))], "i int, cv_smape double")


def _alpha_search(spark, sf):
    tr, _ = _one_feature(spark, sf, "n_chars")
    _, scores = E.tune(R.Ridge(), R.Ridge.alpha, PL.RIDGE_ALPHAS, tr)
    return spark.createDataFrame([(i, s) for i, (_, s) in enumerate(scores)], "i int, cv_smape double")


@register("ridge_alpha_search", _cv_sql(PL.RIDGE_ALPHAS))
def q_ridge_alpha_search(spark, sf):
    return _alpha_search(spark, sf).withColumn("cv_smape", F.round("cv_smape", 4))


@register("model_rank_best", _cv_sql(PL.RIDGE_ALPHAS).replace(
    "select i, round(cv_smape, 4) cv_smape from r",
    "select i, round(cv_smape, 4) cv_smape from r order by r.cv_smape, i limit 1"))
def q_model_rank_best(spark, sf):
    return E.best_by_score(_alpha_search(spark, sf).withColumnRenamed("cv_smape", "smape"), "i").select(
        "i", F.round("smape", 4).alias("cv_smape"))  # ranked raw, rounded for the report


def _l1_sql(ratios: list[float]) -> str:
    """Cross-validated SMAPE of the one-feature elastic net, from totals less the fold's."""
    return with_catalog(
        f"t as (select price y, n_chars x, {_CV} cv from catalog where fold <> 0)",
        "f as (select cv, count(*)::double n, sum(x) sx, sum(y) sy, sum(x * x) sxx, sum(x * y) sxy from t group by cv)",
        "s as (select f.cv, a.n - f.n n, (a.sx - f.sx) / (a.n - f.n) mx, (a.sy - f.sy) / (a.n - f.n) my, "
        "(a.sxx - f.sxx) / (a.n - f.n) exx, (a.sxy - f.sxy) / (a.n - f.n) exy from f, (select sum(n) n, sum(sx) sx, "
        "sum(sy) sy, sum(sxx) sxx, sum(sxy) sxy from f) a)",
        f"r as (select unnest({[float(r) for r in ratios]})::double l1_ratio)",
        "w as (select cv, l1_ratio, mx, my, sign(exy - mx * my) * greatest(abs(exy - mx * my) - 1e-4::double * l1_ratio, 0) "
        "/ (exx - mx * mx + 1e-4::double * (1 - l1_ratio)) b from s, r)",
        f"p as (select cv, l1_ratio, {q.smape('my - b * mx + b * x', 'y')} s from t join w using (cv) group by cv, l1_ratio)",
        select="select l1_ratio, round(avg(s), 6) cv_smape from p group by l1_ratio")


@register("l1_ratio_search_one", _l1_sql(PL.L1_RATIOS))
def q_l1_ratio_search_one(spark, sf):
    """The search on one column, where it has a closed form."""
    tr, _ = _one_feature(spark, sf, "n_chars")
    _, scores = E.tune(R.ElasticNet(alpha=1e-4), R.ElasticNet.l1Ratio, PL.L1_RATIOS, tr)
    return spark.createDataFrame([(r, s) for r, s in scores], "l1_ratio double, cv_smape double").withColumn(
        "cv_smape", F.round("cv_smape", 6))


@register("l1_ratio_search")
def q_l1_ratio_search(spark, sf):
    a, _, _ = PL.prepare(spark, sf, CHECK)
    _, scores = E.tune(R.ElasticNet(alpha=1e-4, maxIter=2000), R.ElasticNet.l1Ratio, PL.L1_RATIOS, a)
    return spark.createDataFrame([(r, s) for r, s in scores], "l1_ratio double, cv_smape double")


# ---- rows 84, 58, 43: out-of-fold predictions ------------------------------------------------------

@register("oof_predictions", with_catalog(*ridge_oof_sql("n_chars", 1.0, "o"), select="""
select sample_id, cv fold, round(prediction, 3) prediction from o"""))
def q_oof_predictions(spark, sf):
    tr, _ = _one_feature(spark, sf, "n_chars")
    oof = E.oof_predictions(tr, {"ridge": R.Ridge(alpha=1.0)})
    return oof.select("sample_id", "fold", r3("prediction").alias("prediction"))


@register("oof_union", with_catalog(select="""
select 'ridge' model, count(*) n, count(distinct sample_id) n_ids from catalog where fold <> 0"""))
def q_oof_union(spark, sf):
    tr, _ = _one_feature(spark, sf, "n_chars")
    oof = E.oof_predictions(tr, {"ridge": R.Ridge(alpha=1.0)})
    return oof.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sample_id").alias("n_ids"))


def _two_feature_oof(spark, sf) -> DataFrame:
    train, _ = train_test(catalog(spark, sf))
    tr = with_folds(train, 5, 42).withColumns({
        "fv_n": array_to_vector(F.array(F.col("n_chars").cast("double"))),
        "fv_s": array_to_vector(F.array(F.col("p_size").cast("double")))})
    return E.oof_predictions(tr, {"ridge_n_chars": R.Ridge(alpha=1.0, featuresCol="fv_n"),
                                  "ridge_p_size": R.Ridge(alpha=1.0, featuresCol="fv_s")})


@register("oof_assemble", with_catalog(*ridge_oof_sql("n_chars", 1.0, "a"), *ridge_oof_sql("p_size", 1.0, "b"),
                                       select="""
select sample_id, round(a.prediction, 3) ridge_n_chars, round(b.prediction, 3) ridge_p_size, round(a.price, 6) price
from a join b using (sample_id)"""))
def q_oof_assemble(spark, sf):
    m = E.oof_matrix(_two_feature_oof(spark, sf), ["ridge_n_chars", "ridge_p_size"])
    return m.select("sample_id", r3("ridge_n_chars").alias("ridge_n_chars"),
                    r3("ridge_p_size").alias("ridge_p_size"), r6("price").alias("price"))


# ---- rows 88-89: voting and weighted ensembles of closed-form members --------------------------------

def _members(spark, sf):
    train, test = train_test(catalog(spark, sf))
    out, smapes = None, {}
    for name, x in (("ridge_n_chars", "n_chars"), ("ridge_p_size", "p_size")):
        tr = train.withColumn("fv", array_to_vector(F.array(F.col(x).cast("double"))))
        te = test.withColumn("fv", array_to_vector(F.array(F.col(x).cast("double"))))
        model = R.Ridge(alpha=1.0).fit(tr)
        smapes[name] = R.SmapeEvaluator().evaluate(model.transform(tr))  # in-sample score sets the weight
        p = model.transform(te).select("sample_id", F.col("prediction").alias(name))
        out = p if out is None else out.join(p, "sample_id")
    return out, smapes


_MEMBER_SQL = [ridge_fit_sql("n_chars", 1.0, "c1"), ridge_fit_sql("p_size", 1.0, "c2"),
               "m as (select sample_id, c1.a + c1.b * n_chars p1, c2.a + c2.b * p_size p2 from catalog, c1, c2)"]


@register("voting_ensemble", with_catalog(*_MEMBER_SQL, select="""
select sample_id, round((p1 + p2) / 2, 3) prediction from m join catalog using (sample_id) where fold = 0"""))
def q_voting(spark, sf):
    preds, _ = _members(spark, sf)
    return E.voting(preds, ["ridge_n_chars", "ridge_p_size"]).select("sample_id", r3("prediction").alias("prediction"))


@register("weighted_ensemble", with_catalog(*_MEMBER_SQL, f"""w as (select 1 / s1 / (1 / s1 + 1 / s2) w1,
  1 / s2 / (1 / s1 + 1 / s2) w2 from (select {q.smape('p1', 'price')} s1, {q.smape('p2', 'price')} s2
  from m join catalog using (sample_id) where fold <> 0))""", select="""
select sample_id, round(w1 * p1 + w2 * p2, 3) prediction from m join catalog using (sample_id), w where fold = 0"""))
def q_weighted(spark, sf):
    preds, smapes = _members(spark, sf)
    return E.weighted(preds, smapes).select("sample_id", r3("prediction").alias("prediction"))


# ---- rows 7, 102, 99: model store, batch scoring, row predictor ---------------------------------------

@register("model_store", with_catalog(ridge_fit_sql("n_chars", 1.0), select="""
select sample_id, round(a + b * n_chars, 3) prediction from catalog, c where fold = 0"""))
def q_model_store(spark, sf):
    from pyspark.ml.regression import LinearRegressionModel

    tr, te = _one_feature(spark, sf, "n_chars")
    path = scratch_path(spark, "model-ridge")
    R.Ridge(alpha=1.0).fit(tr).write().overwrite().save(path)
    return LinearRegressionModel.load(path).transform(te).select("sample_id", r3("prediction").alias("prediction"))


@register("batch_score", with_catalog(ridge_fit_sql("n_chars", 1.0), select="""
select sample_id, round(greatest(a + b * n_chars, 0.01), 3) price from catalog, c where fold = 0"""))
def q_batch_score(spark, sf):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler

    from ..operators.sinks import write_submission

    train, test = train_test(catalog(spark, sf))
    # fit and store a pipeline (assemble → ridge) once
    va = VectorAssembler(inputCols=["n_chars"], outputCol="fv")
    model_path = scratch_path(spark, "pipeline")
    PipelineModel([va, R.Ridge(alpha=1.0).fit(va.transform(train))]).write().overwrite().save(model_path)
    # a new CSV arrives: score it with the stored pipeline and write predictions
    new_csv = scratch_path(spark, "new-items")
    C.write_csv(test.select("sample_id", "catalog_content", "image_link", "n_chars"), new_csv)
    items = C.read_csv(spark, new_csv, "sample_id string, catalog_content string, image_link string, n_chars double")
    out = scratch_path(spark, "scored")
    write_submission(PipelineModel.load(model_path).transform(items), out)
    back = C.read_csv(spark, out, "sample_id string, price double")
    return back.select("sample_id", r3("price").alias("price"))


@register("score_raw_items")
def q_score_raw_items(spark, sf):
    """The whole run with linear members, stored as one pipeline; new items arrive
    as CSV and are scored from their raw text with the loaded pipeline."""
    from pyspark.ml import PipelineModel

    cfg = PL.RunConfig(models=("ridge", "elastic_net"), gbt_rounds=50)
    out = scratch_path(spark, "whole-run")
    PL.run_stacked(spark, sf, cfg, out=out)
    _, test = train_test(catalog(spark, sf))
    new_csv = scratch_path(spark, "raw-items")
    C.write_csv(test.select("sample_id", "catalog_content", "image_link", "p_brand", "p_type", "p_size", "n_chars"), new_csv)
    items = C.read_csv(spark, new_csv, "sample_id string, catalog_content string, image_link string, p_brand string, p_type string, "
                       "p_size int, n_chars double")
    vis = visual_features(read_table(spark, sf, "embeddings"), id_col="vec_id", vec_col="embedding")
    scored = PipelineModel.load(f"{out}/pipeline").transform(items.join(vis, "sample_id", "left"))
    return scored.select("sample_id", r3("price").alias("price"))


@register("row_predictor_udf", with_catalog(select=f"""
select sample_id, round(5 + 495 * {q.uniform01("'42:' || sample_id")}, 2) price from catalog where fold = 0"""))
def q_row_predictor_udf(spark, sf):
    from ..operators.udf import row_predictor

    def predictor(sample_id: str, catalog_content: str, image_link: str) -> float:
        import hashlib

        u = int(hashlib.md5(f"42:{sample_id}".encode()).hexdigest()[:8], 16) / 4294967296.0
        return round(5 + 495 * u, 2)

    _, test = train_test(catalog(spark, sf))
    fn = row_predictor(predictor)
    return test.select("sample_id", fn("sample_id", "catalog_content", "image_link").alias("price"))


# ---- row 6: feature cache -----------------------------------------------------------------------------

def _word_tfidf_sql() -> str:
    from .q_tfidf import WORD, tfidf_ctes

    return with_catalog(*tfidf_ctes("a", WORD), select="select sample_id, term, round(weight, 6) weight from a_w")


@register("feature_cache", _word_tfidf_sql())
def q_feature_cache(spark, sf):
    from ..operators.cache import cached
    from .q_tfidf import WORD, tfidf_all

    root = scratch_path(spark, "feature-cache")
    cat = catalog(spark, sf)
    key_inputs = cat.select("sample_id", "catalog_content", "fold")
    first = cached(root, "word_tfidf", WORD, key_inputs, lambda: tfidf_all(spark, sf, WORD)[1])
    again = cached(root, "word_tfidf", WORD, key_inputs, lambda: (_ for _ in ()).throw(RuntimeError("miss")))
    assert first.count() == again.count()
    return again.select("sample_id", "term", r6("weight").alias("weight"))


# ---- rows 64, 67-68, 71: decompositions and blocks (rows + invariants) ------------------------------------

@register("truncated_svd")
def q_truncated_svd(spark, sf):
    train, test = train_test(catalog(spark, sf))
    cfg = FeatureConfig()
    text = text_column(train)
    vocab, xtr, xte, weights = text_blocks(train, test, text, cfg)
    model = decompose.fit_truncated_svd(xtr, vocab, cfg.svd_k, n_iter=cfg.svd_iter, weights=weights)
    s = model.transform(xtr).unionByName(model.transform(xte))
    return s.select("sample_id", F.transform("svd", lambda v: F.round(v, 6)).alias("svd"))


@register("visual_pca")
def q_visual_pca(spark, sf):
    vis = visual_features(read_table(spark, sf, "embeddings"), id_col="vec_id", vec_col="embedding")
    block = VisualBlock(vis, visual_dim(vis))
    out = block.pca.transform(vis, block.scaler.column("features"), "pca")
    return out.select("sample_id", F.transform("pca", lambda v: F.round(v, 6)).alias("pca"))


@register("visual_block")
def q_visual_block(spark, sf):
    vis = visual_features(read_table(spark, sf, "embeddings"), id_col="vec_id", vec_col="embedding")
    dim = visual_dim(vis)
    block = VisualBlock(vis, dim)
    items = visual_join(catalog(spark, sf).select("sample_id"), vis, dim)
    return block.apply(items).select("sample_id", F.transform("vis", lambda v: F.round(v, 6)).alias("vis"))


@register("final_matrix")
def q_final_matrix(spark, sf):
    train, test, vis = PL.inputs(spark, sf)
    a, b, _ = build_features(train, test, vis)
    return a.unionByName(b, allowMissingColumns=True).select(
        "sample_id", F.transform("features", lambda v: F.round(v, 6)).alias("features"))


# ---- rows 74-76, 85-87, 90, 101: trees, registry, stacking (rows checks) ------------------------------

def _fit_test(spark, sf, est) -> DataFrame:
    a, b, _ = PL.prepare(spark, sf, CHECK)
    return est.fit(a).transform(b).select("sample_id", r3("prediction").alias("prediction"))


@register("sgd_elastic_net")
def q_sgd_elastic_net(spark, sf):
    """Stochastic steps on the whole matrix: the L1 share is searched by
    cross-validated SMAPE, the best one fitted on all rows."""
    a, b, info = PL.prepare(spark, sf, CHECK)
    rows = [x.select("sample_id", *[c for c in ("price", "cv_fold") if c in x.columns], vector_to_array("fv").alias("num"),
                     F.lit(None).cast("array<int>").alias("idx"), F.lit(None).cast("array<double>").alias("w")) for x in (a, b)]
    table = SL.pack(rows[0], info["width"], 0)
    _, scores = PL.sgd_search(rows[0], table, PL.L1_RATIOS)
    best = PL.sgd_refit(table, scores)
    return rows[1].select("sample_id", r3(SL.predictions(rows[1], {-1: best})[0]).alias("prediction"))


@register("random_forest")
def q_random_forest(spark, sf):
    return _fit_test(spark, sf, R.random_forest())


@register("gbt_squared")
def q_gbt_squared(spark, sf):
    return _fit_test(spark, sf, R.base_models()["gbt_depth6"])


@register("gbt_absolute")
def q_gbt_absolute(spark, sf):
    return _fit_test(spark, sf, R.base_models()["gbt_absolute"])


@register("pluggable_model")
def q_pluggable_model(spark, sf):
    from pyspark.ml.regression import DecisionTreeRegressor

    a, _, _ = PL.prepare(spark, sf, CHECK)
    oof = E.oof_predictions(a, {"decision_tree": DecisionTreeRegressor(featuresCol="fv", labelCol="price",
                                                                       maxDepth=6, seed=42)})
    return E.oof_scores(oof)


@register("base_model_registry")
def q_base_model_registry(spark, sf):
    a, _, _ = PL.prepare(spark, sf, CHECK)
    models = R.base_models(CHECK.tree_scale, CHECK.rf_trees, CHECK.gbt_rounds)
    skipped: dict[str, str] = {}
    scores = E.oof_scores(E.oof_predictions(a, models, parallelism=CHECK.parallelism, skipped=skipped))
    why = spark.createDataFrame([(m, skipped.get(m)) for m in models], "model string, skipped string")
    return why.join(scores, "model", "left")


@register("stacker_select")
def q_stacker_select(spark, sf):
    res = PL.run_stacked(spark, sf, CHECK)
    skipped = res["meta"]["stackers_skipped"]
    why = spark.createDataFrame([(m, skipped.get(m)) for m in R.stacker_models()], "model string, skipped string")
    scores = why.join(E.oof_scores(res["stacker_oof"]), "model", "left")
    return scores.withColumn("chosen", F.col("model") == F.lit(res["meta"]["stacker"]))


@register("stack_fit_predict")
def q_stack_fit_predict(spark, sf):
    return PL.run_stacked(spark, sf, CHECK)["submission"].select("sample_id", r3("price").alias("price"))


@register("feature_importance")
def q_feature_importance(spark, sf):
    a, _, info = PL.prepare(spark, sf, CHECK)
    imp = R.random_forest().fit(a).featureImportances.toArray().tolist()
    widths = [("text_svd", info["svd_k"]), ("stats", info["text_stats"]), ("structured", len(info["structured"])),
              ("visual", info["visual"])]
    blocks = [name for name, n in widths for _ in range(n)]
    rows = spark.createDataFrame(list(zip(blocks, imp, strict=True)), "block string, importance double")
    return rows.groupBy("block").agg(F.sum("importance").alias("importance"))


@register("text_model_compare")
def q_text_model_compare(spark, sf):
    """A row a setting: its score, how far its fits came, and whether it won;
    beside it the summary of the winner's predictions."""
    res = PL.run_text_models(spark, sf)
    best = {m: min(s, key=lambda t: t[1])[0] for m, s in (("ridge", res["ridge_scores"]), ("elastic_net", res["enet_scores"]))}
    rows = []
    for m, scores in (("ridge", res["ridge_scores"]), ("elastic_net", res["enet_scores"])):
        for v, s in scores:
            mine = [x for x in res["fits"] if x[0] == m and x[2] == v]
            rows.append((m, float(v), float(s), max(x[3] for x in mine), max(x[4] for x in mine), len(mine),
                         m == res["winner"] and v == best[m]))
    out = spark.createDataFrame(rows, "model string, value double, cv_smape double, worst_residual double, passes long, fits long, chosen boolean")
    return out.crossJoin(F.broadcast(res["summary"]))  # one row


# ---- row 8: run metadata ------------------------------------------------------------------------------

@register("run_metadata_sink")
def q_run_metadata(spark, sf):
    """Metadata of the stacked run with all members, written and read back."""
    out = scratch_path(spark, "run")
    PL.run_stacked(spark, sf, CHECK, out=out)
    return spark.read.json(f"{out}/metadata")
