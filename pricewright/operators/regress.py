"""Regressors as ``pyspark.ml`` estimators (rows 72-76, 79, 100-101).

``Ridge`` and ``ElasticNet`` are solved from Gram tables (``operators/linear.py``)
up to ``MAX_WIDTH`` columns.  Wider ones wrap ``LinearRegression`` with the penalty
mapping that reproduces the reference's objectives (SURVEY §8): Spark scales the
L2 term by the label's standard deviation when ``standardization=False``, so the
strength is rescaled from one aggregate of the label per fit.  Trees are histogram
trees (``operators/boosting.py``).  Everything accepts a vector ``featuresCol`` and
plugs into ``CrossValidator``; the ensemble functions fit folds and members of
both kinds together.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linear as L
from .boosting import TreeSpec
from .metrics import smape, smape_drop_zero
from .trees import TreeEnsemble, vector_width


class _Linear(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    alpha = Param(Params._dummy(), "alpha", "penalty strength", typeConverter=TypeConverters.toFloat)
    l1Ratio = Param(Params._dummy(), "l1Ratio", "share of L1 in the penalty", typeConverter=TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations of the iterative solver", typeConverter=TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "convergence tolerance of the iterative solver", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, alpha: float = 1.0, l1Ratio: float = 0.0, maxIter: int = 100, tol: float = 1e-10,
                 featuresCol: str = "fv", labelCol: str = "price", predictionCol: str = "prediction"):
        super().__init__()
        self._setDefault(alpha=1.0, l1Ratio=0.0, maxIter=100, tol=1e-10, featuresCol="fv", labelCol="price",
                         predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _label_stats(self, df: DataFrame):
        y = F.col(self.getLabelCol())
        r = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(y).alias("sp"), F.stddev_samp(y).alias("ss")).first()
        return r["n"], r["sp"] or 0.0, r["ss"] or 0.0

    def _lr(self, reg: float, enet: float, solver: str) -> LinearRegression:
        return LinearRegression(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
                                predictionCol=self.getPredictionCol(), regParam=reg, elasticNetParam=enet,
                                standardization=False, solver=solver, maxIter=self.getOrDefault("maxIter"),
                                tol=self.getOrDefault("tol"))


    def solve(self, gram: L.Gram, penalty: float | None = None):
        """(w, b) from a Gram table; ``penalty`` replaces the searched parameter."""
        raise NotImplementedError

    def _from_gram(self, df: DataFrame, width: int) -> LinearRegressionModel:
        tables = L.gram_tables(df, self.getFeaturesCol(), self.getLabelCol(), width)
        return self.wrap(df, *self.solve(L.without_fold(tables, -2)))

    def wrap(self, df: DataFrame, w, intercept: float) -> LinearRegressionModel:
        return L.as_model(df, w, intercept, self.getFeaturesCol(), self.getPredictionCol())


class Ridge(_Linear):
    """min ‖y − Xw − b‖² + α‖w‖² (no 1/n).  ``solver='normal'``: exact, from the
    Gram table, up to ``MAX_WIDTH`` columns; ``l-bfgs`` above."""

    solver = Param(Params._dummy(), "solver", "normal or l-bfgs", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, alpha: float = 1.0, solver: str = "normal", maxIter: int = 100, tol: float = 1e-10,
                 featuresCol: str = "fv", labelCol: str = "price", predictionCol: str = "prediction"):
        super(_Linear, self).__init__()
        self._setDefault(alpha=1.0, l1Ratio=0.0, maxIter=100, tol=1e-10, solver="normal", featuresCol="fv",
                         labelCol="price", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def solve(self, gram: L.Gram, penalty: float | None = None):
        return L.solve_ridge(gram, self.getOrDefault("alpha") if penalty is None else penalty)

    def _fit(self, df: DataFrame):
        solver = self.getOrDefault("solver")
        width = vector_width(df, self.getFeaturesCol())
        if solver == "normal" and 0 < width <= L.MAX_WIDTH:
            return self._from_gram(df, width)
        n, sp, ss = self._label_stats(df)
        sd = sp if solver == "normal" else ss
        reg = self.getOrDefault("alpha") * (sd if sd > 0 else 1.0) / max(n, 1)
        return self._lr(reg, 0.0, solver).fit(df)


class ElasticNet(_Linear):
    """min 1/(2n)‖y − Xw − b‖² + α·r‖w‖₁ + α(1−r)/2‖w‖² (coordinate-descent form)."""

    def solve(self, gram: L.Gram, penalty: float | None = None):
        return L.solve_elastic_net(gram, self.getOrDefault("alpha"), self.getOrDefault("l1Ratio") if penalty is None else penalty)

    def _fit(self, df: DataFrame):
        width = vector_width(df, self.getFeaturesCol())
        if 0 < width <= L.MAX_WIDTH:
            return self._from_gram(df, width)
        n, sp, ss = self._label_stats(df)
        a, r = self.getOrDefault("alpha"), self.getOrDefault("l1Ratio")
        l1 = a * r
        l2 = a * (1 - r) * (ss if ss > 0 else 1.0)
        reg = l1 + l2
        enet = l1 / reg if reg > 0 else 0.0
        return self._lr(reg, enet, "l-bfgs").fit(df)


def random_forest(num_trees: int = 100, seed: int = 42, **kw) -> TreeEnsemble:
    """100 trees, depth 10, nodes of ≥ 10 rows split into leaves of ≥ 5, every
    feature at every split, rows drawn with replacement."""
    return TreeEnsemble(spec=TreeSpec(trees=num_trees, kind="forest", depth=10, min_leaf=5, min_split=10, seed=seed), **kw)


def gbt_leafwise(rounds: int, leaves: int = 31, rate: float = 0.05, share: float = 0.8, l1: float = 0.1, l2: float = 0.1,
                 **kw) -> TreeEnsemble:
    """The leaf with the largest gain is split first; leaves of ≥ 20 rows."""
    return TreeEnsemble(spec=TreeSpec(trees=rounds, growth="leaf", depth=None, leaves=leaves, rate=rate, rows=share, columns=share,
                                      l1=l1, l2=l2, min_leaf=20), **kw)


def gbt_depth(rounds: int, depth: int = 6, rate: float = 0.05, share: float = 0.8, l1: float = 0.1, l2: float = 1.0, **kw
              ) -> TreeEnsemble:
    """Level by level to a depth."""
    return TreeEnsemble(spec=TreeSpec(trees=rounds, depth=depth, rate=rate, rows=share, columns=share, l1=l1, l2=l2), **kw)


def gbt_absolute(rounds: int, depth: int = 6, rate: float = 0.05, l2: float = 3.0, **kw) -> TreeEnsemble:
    """Absolute loss: oblivious trees whose leaves are medians of the residuals."""
    return TreeEnsemble(spec=TreeSpec(trees=rounds, growth="oblivious", loss="absolute", depth=depth, rate=rate, l2=l2), **kw)


def base_models(tree_scale: float = 1.0, rf_trees: int | None = None, gbt_rounds: int | None = None
                ) -> dict[str, Estimator]:
    """Named candidates (row 85).  ``tree_scale`` multiplies tree and boosting
    round counts (1.0 = the reference's counts); ``rf_trees`` / ``gbt_rounds``
    set them outright.  Fixed values: counts, rates, penalties and shares are the
    reference's."""

    def n(v: int) -> int:
        return gbt_rounds if gbt_rounds is not None else max(1, int(round(v * tree_scale)))

    return {
        "ridge": Ridge(alpha=1.0),
        "elastic_net": ElasticNet(alpha=0.5, l1Ratio=0.7, maxIter=2000),
        "random_forest": random_forest(rf_trees if rf_trees is not None else max(1, int(round(100 * tree_scale)))),
        "gbt_leafwise": gbt_leafwise(n(1000)),
        "gbt_depth6": gbt_depth(n(800)),
        "gbt_absolute": gbt_absolute(n(1000)),
    }


def stacker_models(tree_scale: float = 1.0, gbt_rounds: int | None = None) -> dict[str, Estimator]:
    rounds = gbt_rounds if gbt_rounds is not None else max(1, int(round(500 * tree_scale)))
    return {
        "ridge": Ridge(alpha=1.0, featuresCol="sv"),
        "elastic_net": ElasticNet(alpha=0.1, l1Ratio=0.5, maxIter=2000, featuresCol="sv"),
        "gbt": gbt_leafwise(rounds, leaves=15, rate=0.1, share=0.9, l1=0.0, l2=0.0, featuresCol="sv"),
    }


class SmapeEvaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """SMAPE as a Spark ML evaluator (smaller is better).  ``drop_zero`` picks
    the variant that removes 0/0 rows."""

    dropZero = Param(Params._dummy(), "dropZero", "remove rows where both are 0", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, labelCol: str = "price", predictionCol: str = "prediction", dropZero: bool = False):
        super().__init__()
        self._setDefault(labelCol="price", predictionCol="prediction", dropZero=False)
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        f = smape_drop_zero if self.getOrDefault("dropZero") else smape
        return float(dataset.agg(f(self.getPredictionCol(), self.getLabelCol())).first()[0] or 0.0)

    def isLargerBetter(self) -> bool:
        return False


class ColumnMetric(Evaluator):
    """Any aggregate Column expression as a metric (row 100)."""

    def __init__(self, expr: Column, larger_is_better: bool = False):
        super().__init__()
        self.expr, self.larger = expr, larger_is_better

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(dataset.agg(self.expr).first()[0])

    def isLargerBetter(self) -> bool:
        return self.larger
