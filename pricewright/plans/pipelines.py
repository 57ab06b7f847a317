"""The two end-to-end pipelines as Spark jobs.

``run_stacked``: features → out-of-fold predictions of the base models →
stacker chosen by out-of-fold SMAPE → bases refitted on all rows → stacker
prediction for test → floor → submission + run metadata.

``run_text_models``: cleaned text → TF-IDF (sparse arrays) ‖ numeric columns →
ridge α search vs. elastic-net l1-ratio search (SGD) by CV SMAPE → fit winner →
predict → floor → summary.

Feature matrices are written once with a reliable checkpoint into the shared
checkpoint folder, so the many fits that follow read them instead of
recomputing (and losing an executor does not recompute the features).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.numeric import price_floor
from ..operators import ensemble as E
from ..operators import regress as R
from ..operators import select as S
from ..operators import sparse_linear as SL
from ..operators import tfidf as T
from ..operators.folds import with_folds
from ..operators import stages as ST
from ..operators.metrics import smape
from ..operators.sinks import write_run_metadata, write_submission
from ..session import BROADCAST_MAX_ROWS, cut_lineage, fit_table
from ..sources.tables import catalog, read_table, train_test
from ..sources.visual import visual_features
from .features import FeatureConfig, build_features

K_FOLDS = 5


@dataclass
class RunConfig:
    tree_scale: float = 1.0  # 1.0 = the reference's tree / round counts
    rf_trees: int | None = None  # set counts outright (checks: 20)
    gbt_rounds: int | None = None
    features: FeatureConfig = field(default_factory=FeatureConfig)
    fit_stacker_on: str = "oof"  # "oof" or "in_sample" (the reference's choice)
    parallelism: int = 8
    models: tuple[str, ...] | None = None  # subset of base_models() names


def inputs(spark: SparkSession, sf: str):
    """Train (with its CV fold), test and the visual table."""
    train, test = train_test(catalog(spark, sf))
    train = with_folds(train, K_FOLDS, 42)
    vis = visual_features(read_table(spark, sf, "embeddings"), id_col="vec_id", vec_col="embedding")
    return train, test, vis


def prepare(spark: SparkSession, sf: str, cfg: RunConfig):
    train, test, vis = inputs(spark, sf)
    a, b, info = build_features(train, test, vis, cfg.features)
    size = 8 * info["width"] + 64
    return fit_table(E.with_vector(a).drop("features"), size), fit_table(E.with_vector(b).drop("features"), size), info


def predict_all(fitted: dict, pred_df: DataFrame) -> DataFrame:
    parts = [m.transform(pred_df).select("sample_id", F.lit(name).alias("model"), "prediction") for name, m in fitted.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return cut_lineage(out)


def run_stacked(spark: SparkSession, sf: str, cfg: RunConfig | None = None, out: str | None = None) -> dict:
    """The whole stacked run.  Members and stackers that cannot be fitted are
    reported in ``meta["skipped"]`` and ``meta["stackers_skipped"]``.  With ``out``, the submission, the metadata and the
    fitted models are written below that folder."""
    cfg = cfg or RunConfig()
    a, b, info = prepare(spark, sf, cfg)
    models = R.base_models(cfg.tree_scale, cfg.rf_trees, cfg.gbt_rounds)
    if cfg.models:
        models = {k: v for k, v in models.items() if k in cfg.models}
    skipped: dict[str, str] = {}
    fitted: dict = {}  # on all rows, trained together with the folds
    oof = E.oof_predictions(a, models, k=K_FOLDS, parallelism=cfg.parallelism, skipped=skipped, full=fitted)
    models = {k: v for k, v in models.items() if k not in skipped}
    names = list(models)
    base_scores = {r["model"]: r["smape"] for r in E.oof_scores(oof).collect()}  # one row per model

    # stacker: candidates scored by their own out-of-fold SMAPE on the OOF matrix
    mat = E.oof_matrix(oof, names).withColumn("sv", array_to_vector(F.array(*[F.col(m) for m in names])))
    mat = cut_lineage(with_folds(mat, K_FOLDS, 42))
    stackers = R.stacker_models(cfg.tree_scale, cfg.gbt_rounds)
    st_skipped: dict[str, str] = {}
    st_oof = E.oof_predictions(mat, stackers, k=K_FOLDS, parallelism=cfg.parallelism, skipped=st_skipped)
    st_scores = {r["model"]: r["smape"] for r in E.oof_scores(st_oof).collect()}
    order = [m for m in stackers if m in st_scores]
    best = min(order, key=lambda m: (st_scores[m], order.index(m)))  # earlier wins ties

    # bases on all rows predict test; stacker on OOF (default) or in-sample
    test_preds = predict_all(fitted, b)
    test_mat = test_preds.groupBy("sample_id").pivot("model", names).agg(F.first("prediction"))
    test_mat = test_mat.withColumn("sv", array_to_vector(F.array(*[F.col(m) for m in names])))
    if cfg.fit_stacker_on == "in_sample":
        ins = predict_all(fitted, a)
        fit_mat = ins.groupBy("sample_id").pivot("model", names).agg(F.first("prediction")).join(
            a.select("sample_id", "price"), "sample_id")
        fit_mat = fit_mat.withColumn("sv", array_to_vector(F.array(*[F.col(m) for m in names])))
    else:
        fit_mat = mat
    stacker = stackers[best].fit(fit_mat)
    pred = stacker.transform(test_mat).select("sample_id", price_floor("prediction").alias("prediction"))
    submission = pred.select("sample_id", F.col("prediction").alias("price"))
    meta = {
        "base_models": names, "skipped": skipped, "cv_scores": base_scores, "stacker": best, "stacker_scores": st_scores, "stackers_skipped": st_skipped,
        "n_train": a.count(), "n_test": b.count(), "n_features": info["width"],
        "feature_info": {k: v for k, v in info.items() if k not in ("singular_values", "fitted")},
    }
    whole = ST.whole_pipeline(info["fitted"], fitted, stacker)
    if out:
        write_submission(pred, f"{out}/submission")
        write_run_metadata(spark, meta, f"{out}/metadata")
        for name, m in {**fitted, f"stacker-{best}": stacker}.items():
            m.write().overwrite().save(f"{out}/models/{name}")
        whole.write().overwrite().save(f"{out}/pipeline")
    return {"train": a, "test": b, "oof": oof, "skipped": skipped, "fitted": fitted, "oof_matrix": mat, "stacker_oof": st_oof, "test_preds": test_preds,
            "test_matrix": test_mat, "submission": submission, "meta": meta, "stacker_model": stacker,
            "pipeline": whole}


# ---- text pipeline -----------------------------------------------------------------------------

# Fixed values (must equal the reference): vectoriser settings and search grids.
TEXT_PARAMS = T.TfidfParams(T.Analyzer("word", 1, 2, stop_words=True, strip_accents=False), min_df=3, max_df=0.98,
                            max_features=20000)
RIDGE_ALPHAS = [10 ** (-3 + 6 * i / 7) for i in range(8)]  # 8 values log-spaced over 1e-3 … 1e3
L1_RATIOS = [0.05, 0.15, 0.3, 0.5]


def text_rows(train: DataFrame, test: DataFrame, params: T.TfidfParams = TEXT_PARAMS):
    """Both sets with ``idx`` and ``w`` (term numbers and TF-IDF weights of the
    cleaned text, as arrays) beside ``num`` (the numeric columns, unscaled); the
    indexed vocabulary and the names of the columns."""
    if params.max_features is None or params.max_features > BROADCAST_MAX_ROWS:
        raise ValueError(f"max_features must be set, and not exceed {BROADCAST_MAX_ROWS}")
    text = tx.preprocess(S.select_text_catalog(train))
    fitted = T.fit_blocks(train, [test], text, [params])
    xtr, xte = fitted.arrays()
    terms = fitted.vocab.select("term", "idf", "idx")
    num = S.common_numeric(train, test.drop("price"), exclude=("price", "fold", "cv_fold", "has_visual", "price_raw"))

    def rows(x: DataFrame, items: DataFrame) -> DataFrame:
        keep = [c for c in ("sample_id", "price", "cv_fold") if c in items.columns]
        numbers = F.array(*[F.col(c).cast("double") for c in num]) if num else F.array().cast("array<double>")
        return S.fill_numeric_nulls(items, num).select(*keep, numbers.alias("num")).join(x, "sample_id", "left")

    return rows(xtr, train), rows(xte, test), terms, num


def cv_scores(rows: DataFrame, paths: dict[int, SL.Path], values: list[float]) -> list[tuple[float, float]]:
    """(value, mean over folds of SMAPE) of the models fitted without each fold."""
    p = rows.select("price", "cv_fold", SL.predictions(rows, paths, fold=F.col("cv_fold")).alias("p"))
    got = p.groupBy("cv_fold").agg(*[smape(F.col("p")[i], "price").alias(f"s{i}") for i in range(len(values))]).collect()
    return [(v, sum(r[f"s{i}"] for r in got) / max(1, len(got))) for i, v in enumerate(values)]


def sgd_search(rows: DataFrame, table: SL.SparseTable, l1_ratios: list[float]) -> tuple[dict[int, SL.Path], list[tuple[float, float]]]:
    """The stochastic elastic net of every L1 share without each fold, ended by
    its held-out rows, and the shares' cross-validated SMAPE."""
    paths = SL.sgd_path(table, l1_ratios, table.folds)
    return paths, cv_scores(rows, paths, l1_ratios)


def sgd_refit(table: SL.SparseTable, scores: list[tuple[float, float]]) -> SL.Path:
    """The best share (the earlier of equals) fitted on all rows, none held out."""
    return SL.sgd_path(table, [min(scores, key=lambda t: t[1])[0]], [-1], early=False)[-1]


def run_text_models(spark: SparkSession, sf: str, alphas=None, l1_ratios=None, out: str | None = None) -> dict:
    """Ridge against elastic net on sparse text, each at its best setting by
    cross-validated SMAPE; the winner is fitted on all rows.  ``fits`` has a row
    a fit: how far its residual (ridge) or held-out error (SGD) came."""
    alphas, l1_ratios = list(alphas or RIDGE_ALPHAS), list(l1_ratios or L1_RATIOS)
    train, test, _ = inputs(spark, sf)
    a, b, terms, num = text_rows(train, test)
    a, b = cut_lineage(a), cut_lineage(b)
    table = SL.pack(a, len(num), terms.count())
    ridge = SL.ridge_path(table, alphas, [*table.folds, -1], tolerance=1e-4)  # the reference's solver tolerance
    ridge_scores = cv_scores(a, ridge, alphas)
    sgd, enet_scores = sgd_search(a, table, l1_ratios)
    fits = [(m, f, float(v), float(paths[f].residual[i]), paths[f].passes) for m, paths, values in
            (("ridge", ridge, alphas), ("elastic_net", sgd, l1_ratios)) for f in paths for i, v in enumerate(values)]
    (r_at, r_best), (_, e_best) = min(ridge_scores, key=lambda t: t[1]), min(enet_scores, key=lambda t: t[1])
    if r_best <= e_best:
        k = alphas.index(r_at)
        best = SL.Path(ridge[-1].coef[:, [k]], ridge[-1].intercept[[k]], ridge[-1].residual[[k]], ridge[-1].passes)
    else:
        best = sgd_refit(table, enet_scores)
    pred = b.select("sample_id", price_floor(SL.predictions(b, {-1: best})[0]).alias("prediction"))
    summary = pred.agg(F.min("prediction").alias("min"), F.max("prediction").alias("max"),
                       F.avg("prediction").alias("mean"), F.stddev_pop("prediction").alias("std"))
    if out:
        write_submission(pred, f"{out}/submission")
        named = {r["idx"]: r["term"] for r in terms.collect()}  # bounded by max_features
        weights = [(c, float(v)) for c, v in zip(num, best.coef[:, 0])] + [(named[j], float(v)) for j, v in enumerate(best.coef[len(num):, 0])]
        spark.createDataFrame([("(intercept)", float(best.intercept[0])), *weights], "feature string, weight double"
                              ).coalesce(1).write.mode("overwrite").parquet(f"{out}/models/best")
    return {"ridge_scores": ridge_scores, "enet_scores": enet_scores, "fits": fits,
            "winner": "ridge" if r_best <= e_best else "elastic_net",
            "predictions": pred, "summary": summary, "test": b}
