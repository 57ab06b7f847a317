"""Model selection and ensembles (rows 43, 47, 56, 58, 80-90).

Predictions are always keyed by ``sample_id``: fold outputs are unioned per
model and models meet by id (a pivot), never by row position.  Linear members
share one pass for the Gram tables of all folds, tree members share their binned
table and every level's job; other estimators are fitted as independent Spark
jobs from a few driver threads, as ``CrossValidator(parallelism=…)`` does.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, fit_table
from . import linear as L
from . import trees as T
from .metrics import smape, smape_drop_zero
from .regress import ElasticNet, Ridge, SmapeEvaluator


def with_vector(df: DataFrame, arr: str = "features", out: str = "fv") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(arr)))


def fit_folds(train: DataFrame, models: dict[str, Estimator], fold_col: str | None, folds: list[int], parallelism: int = 4
              ) -> dict[tuple[str, int], Model | Exception]:
    """Every model fitted without each of the folds (-1: on all rows); an
    exception where a fit failed."""
    out: dict[tuple[str, int], Model | Exception] = {}
    dense = {n: m for n, m in models.items() if type(m) in (Ridge, ElasticNet) and _has_gram(train, m)}
    forests = {n: m for n, m in models.items() if type(m) is T.TreeEnsemble}
    rest = [(n, f) for n in models if n not in dense and n not in forests for f in folds]

    def columns(m: Estimator) -> tuple[str, str]:
        return m.getOrDefault("featuresCol"), m.getOrDefault("labelCol")

    for cols in sorted({columns(m) for m in dense.values()}):
        mine = {n: m for n, m in dense.items() if columns(m) == cols}
        try:
            tables = L.gram_tables(train, *cols, T.vector_width(train, cols[0]), fold_col)
            for n, m in mine.items():
                for f in folds:
                    try:
                        out[n, f] = m.wrap(train, *m.solve(L.without_fold(tables, f if f >= 0 else -2)))
                    except Exception as e:
                        out[n, f] = e
        except Exception as e:
            out |= {(n, f): e for n in mine for f in folds}
    for cols in sorted({columns(m) for m in forests.values()}):
        mine = {n: m for n, m in forests.items() if columns(m) == cols}
        try:
            out |= T.fit_folds(train, mine, fold_col, folds)
        except Exception as together:
            if len(mine) == 1:
                out |= {(n, f): together for n in mine for f in folds}
            for n, m in mine.items() if len(mine) > 1 else ():  # one of them fails: the others go on
                try:
                    out |= T.fit_folds(train, {n: m}, fold_col, folds)
                except Exception as e:
                    out |= {(n, f): e for f in folds}

    def run(job):
        name, f = job
        try:
            return models[name].fit(train if f < 0 else train.filter(F.col(fold_col) != f))
        except Exception as e:
            return e

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        out |= dict(zip(rest, pool.map(run, rest)))
    return out


def _has_gram(train: DataFrame, m: Estimator) -> bool:
    if isinstance(m, Ridge) and m.getOrDefault("solver") != "normal":
        return False
    return 0 < T.vector_width(train, m.getOrDefault("featuresCol")) <= L.MAX_WIDTH


def reason(e: Exception) -> str:
    return f"{type(e).__name__}: {(str(e).splitlines() or [''])[0][:200]}"


def _width(df: DataFrame, vec: str) -> int:
    """Numbers that a vector column stores in a row, by its first row."""
    row = df.select(vec).first()
    return 0 if row is None or row[0] is None else len(row[0].values if hasattr(row[0], "indices") else row[0])


def oof_predictions(train: DataFrame, models: dict[str, Estimator], fold_col: str = "cv_fold", k: int = 5,
                    label: str = "price", parallelism: int = 4, skipped: dict[str, str] | None = None,
                    full: dict[str, Model] | None = None) -> DataFrame:
    """(sample_id, model, prediction, price): every training row predicted by a
    model fitted without its fold (row 84); the union over folds covers every
    row exactly once per model (row 58).

    A member that fails, while it is fitted or while it predicts, is an error,
    unless ``skipped`` is given: it then gets the member's name and reason, and
    the others go on; none left is an error.  ``full``, if given, gets the
    members fitted on all rows, which are trained together with the folds."""
    vectors = sorted({est.getOrDefault("featuresCol") for est in models.values()})
    width = sum(_width(train, v) for v in vectors)
    train = fit_table(train.select("sample_id", fold_col, label, *vectors), 8 * width + 64)
    fitted = fit_folds(train, models, fold_col, [*range(k), *([-1] if full is not None else [])], parallelism)
    parts = []
    for name in models:
        try:
            mine = [fitted[name, f] for f in range(k)]
            for m in (fitted[key] for key in fitted if key[0] == name):
                if isinstance(m, Exception):
                    raise m
            out = None
            for f, m in enumerate(mine):
                part = m.transform(train.filter(F.col(fold_col) == f)).select(
                    "sample_id", "prediction", label, F.lit(name).alias("model"), F.lit(f).alias("fold"))
                out = part if out is None else out.unionByName(part)
            # one reliable checkpoint a member: a failure while predicting shows here,
            # and later steps do not carry a long union lineage
            parts.append(cut_lineage(out))
            if full is not None:
                full[name] = fitted[name, -1]
        except Exception as e:
            if skipped is None:
                raise
            skipped[name] = reason(e)
    if not parts:
        raise RuntimeError(f"no model could be fitted: {skipped}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def oof_scores(oof: DataFrame, label: str = "price") -> DataFrame:
    """Pooled SMAPE per model (0/0 rows removed, as the main pipeline scores)."""
    return oof.groupBy("model").agg(smape_drop_zero("prediction", label).alias("smape"),
                                    F.count(F.lit(1)).alias("n"))


def oof_matrix(oof: DataFrame, models: list[str], label: str = "price") -> DataFrame:
    """One row per id, one column per model (row 43): a pivot with the model
    list given, so Spark does not have to discover it."""
    wide = oof.groupBy("sample_id").pivot("model", models).agg(F.first("prediction"))
    lab = oof.select("sample_id", label).dropDuplicates(["sample_id"])
    wide = wide.join(lab, "sample_id")
    # NaN / ±inf → 0 before the stacker sees them
    for m in models:
        wide = wide.withColumn(m, F.when(F.col(m).isNull() | F.isnan(m) | (F.abs(m) == float("inf")), 0.0)
                               .otherwise(F.col(m)))
    return wide


def best_by_score(scores: DataFrame, order_col: str = "position") -> DataFrame:
    """Lowest SMAPE; ties go to the earlier candidate (row 56)."""
    return scores.orderBy(F.col("smape").asc(), F.col(order_col).asc()).limit(1)


@dataclass
class Tuned:
    """The model with the best value, refitted on all rows."""

    bestModel: Model
    avgMetrics: list[float]


def tune(est: Estimator, grid_param, values: list[float], train: DataFrame, fold_col: str = "cv_fold",
         parallelism: int = 8, k: int = 5):
    """Cross validation over the given fold column scored by SMAPE; refits the
    best setting on all rows (rows 80-82).  Dense linear models are solved for
    all folds and values from one pass; others go through CrossValidator."""
    cols = [est.getOrDefault("featuresCol"), est.getOrDefault("labelCol"), fold_col]
    train = fit_table(train.select(*cols), 8 * _width(train, cols[0]) + 64)
    searched = {Ridge: "alpha", ElasticNet: "l1Ratio"}.get(type(est))
    if searched == grid_param.name and _has_gram(train, est):
        means, gram = L.cross_validate(train, *cols, T.vector_width(train, cols[0]), est.solve, values, smape)
        best = min(range(len(values)), key=lambda i: means[i])
        return Tuned(est.wrap(train, *est.solve(gram, values[best])), means), list(zip(map(float, values), means))
    # the estimator's own parameter: a class attribute belongs to no instance and would be ignored
    grid = ParamGridBuilder().addGrid(est.getParam(grid_param.name), values).build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=SmapeEvaluator(),
                        foldCol=fold_col, numFolds=k, parallelism=parallelism)
    m = cv.fit(train)
    return m, [(float(v), float(s)) for v, s in zip(values, m.avgMetrics)]


def voting(preds: DataFrame, models: list[str]) -> DataFrame:
    """Plain mean of the chosen models' predictions (row 88)."""
    return preds.select("sample_id", (sum(F.col(m) for m in models) / len(models)).alias("prediction"))


def weighted(preds: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Weights ∝ 1/SMAPE, normalised (row 89)."""
    inv = {m: 1.0 / max(s, 1e-12) for m, s in weights.items()}
    tot = sum(inv.values())
    return preds.select("sample_id", sum(F.col(m) * (w / tot) for m, w in inv.items()).alias("prediction"))
