"""Penalised least squares from Gram tables (rows 72, 73, 80-82).

One pass over the rows adds up, for each fold, the products of the columns with
each other and with the label.  The table of a training set is the total less
its fold's, so every fold and every penalty is solved on the driver from
(width x width) numbers: the ridge by a linear system, the elastic net by
coordinate descent that ends with an exact solve on the active columns.  Cross
validation then takes one more pass, which scores all penalties of a row's fold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Widest matrix whose Gram table is held on the driver (and sent by each task).
MAX_WIDTH = 4096
CHUNK = 64  # rows of the table in a record


@dataclass
class Gram:
    """Count, means and centred products of one set of rows."""

    n: float
    mean_x: np.ndarray
    mean_y: float
    xx: np.ndarray
    xy: np.ndarray
    yy: float

    @staticmethod
    def of(table: np.ndarray) -> Gram:
        """From the products of (1, columns, label)."""
        n = table[0, 0]
        if not n:
            d = len(table) - 2
            return Gram(0.0, np.zeros(d), 0.0, np.zeros((d, d)), np.zeros(d), 0.0)
        m, my = table[0, 1:-1] / n, table[0, -1] / n
        return Gram(n, m, my, table[1:-1, 1:-1] - n * np.outer(m, m), table[1:-1, -1] - n * m * my, table[-1, -1] - n * my * my)

    def intercept(self, w: np.ndarray) -> float:
        return float(self.mean_y - self.mean_x @ w)


def gram_tables(df: DataFrame, features: str, label: str, width: int, fold: str | None = None) -> dict[int, np.ndarray]:
    """Products of (1, columns, label) by fold, from one pass; -1 without folds."""
    if width > MAX_WIDTH:
        raise ValueError(f"more than {MAX_WIDTH} columns")
    rows = df.select((F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"), F.col(label).cast("double").alias("y"),
                     vector_to_array(features).alias("x"))
    side = width + 2

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            fold_of = b["fold"].to_numpy()
            z = np.column_stack([np.ones(len(b)), np.stack(b["x"].to_numpy()), b["y"].to_numpy(float)]) if len(b) else np.zeros((0, side))
            for f in np.unique(fold_of):
                part = z[fold_of == f]
                total[int(f)] = total.get(int(f), 0.0) + part.T @ part
        for f, t in total.items():
            for at in range(0, side, CHUNK):
                yield pd.DataFrame({"fold": [f], "at": [at], "data": [t[at:at + CHUNK].tobytes()]})

    def added(group: pd.DataFrame) -> pd.DataFrame:
        return group.iloc[:1].assign(data=[np.sum([np.frombuffer(x, float) for x in group["data"]], axis=0).tobytes()])

    shape = "fold int, at int, data binary"
    salted = rows.mapInPandas(count, shape).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    parts = salted.groupBy("fold", "at", "salt").applyInPandas(added, shape + ", salt int").drop("salt")
    out: dict[int, np.ndarray] = {}
    for r in parts.groupBy("fold", "at").applyInPandas(added, shape).collect():  # (width + 2)**2 numbers a fold
        t = out.setdefault(r["fold"], np.zeros((side, side)))
        part = np.frombuffer(r["data"], float).reshape(-1, side)
        t[r["at"]:r["at"] + len(part)] = part
    return out


def without_fold(tables: dict[int, np.ndarray], held: int) -> Gram:
    """The training set of a fold: the total less the fold."""
    side = len(next(iter(tables.values()))) if tables else 2
    return Gram.of(sum((t for f, t in tables.items() if f != held), np.zeros((side, side))))


def solve_ridge(g: Gram, alpha: float) -> tuple[np.ndarray, float]:
    """min |y - Xw - b|^2 + alpha |w|^2."""
    a = g.xx + alpha * np.eye(len(g.xx))
    try:
        w = np.linalg.solve(a, g.xy)
    except np.linalg.LinAlgError:  # alpha 0 and dependent columns: the shortest solution
        w = np.linalg.lstsq(a, g.xy, rcond=None)[0]
    return w, g.intercept(w)


def solve_elastic_net(g: Gram, alpha: float, l1_ratio: float, start: np.ndarray | None = None, sweeps: int = 20_000
                      ) -> tuple[np.ndarray, float]:
    """min 1/(2n) |y - Xw - b|^2 + alpha r |w|_1 + alpha (1 - r) / 2 |w|^2.  Ends when
    the optimality conditions hold to rounding: after sweeps over the columns, or,
    where nearly dependent columns make those crawl, after active-set steps."""
    d = len(g.xx)
    l1, l2 = alpha * l1_ratio * g.n, alpha * (1 - l1_ratio) * g.n
    diag = np.diag(g.xx) + l2
    w = np.zeros(d) if start is None else start.copy()
    free = np.flatnonzero(diag > 1e-12 * max(1.0, diag.max(initial=0.0)))
    w[np.setdiff1d(np.arange(d), free)] = 0.0
    scale = max(np.abs(g.xy).max(initial=0.0), l1, 1e-300)

    def violation(w: np.ndarray) -> float:
        slope = g.xy - g.xx @ w - l2 * w
        on = w != 0
        off = np.maximum(np.abs(slope[~on]) - l1, 0.0)
        return max(np.abs(slope[on] - l1 * np.sign(w[on])).max(initial=0.0), off.max(initial=0.0)) / scale

    def polished(w: np.ndarray) -> np.ndarray:
        on = np.flatnonzero(w)
        out = np.zeros(d)
        if len(on):
            try:
                out[on] = np.linalg.solve(g.xx[np.ix_(on, on)] + l2 * np.eye(len(on)), g.xy[on] - l1 * np.sign(w[on]))
            except np.linalg.LinAlgError:
                return w
        return out if (np.sign(out) == np.sign(w)).all() else w

    def stepped(w: np.ndarray) -> np.ndarray:
        """Active-set steps: the exact solution for the signs at hand, or the best
        point on the way there where a coefficient changes sign; then the column
        that violates most joins.  The objective falls with every step, so no set
        of signs comes twice."""
        w, tiny = w.copy(), 1e-11 * scale
        for _ in range(100 + 50 * d):
            slope = g.xy - g.xx @ w - l2 * w
            sign = np.sign(w)
            if np.abs(slope - l1 * sign)[sign != 0].max(initial=0.0) <= tiny:
                over = np.where(sign[free] == 0, np.abs(slope[free]) - l1, -np.inf)
                if over.max(initial=-np.inf) <= tiny:
                    return w
                j = free[np.argmax(over)]
                sign[j] = np.sign(slope[j])
            on = np.flatnonzero(sign)
            a = g.xx[np.ix_(on, on)] + l2 * np.eye(len(on))
            try:
                way = np.linalg.solve(a, slope[on] + a @ w[on] - l1 * sign[on]) - w[on]
            except np.linalg.LinAlgError:
                return w
            if np.abs(way).max() > 1e12 * max(1.0, np.abs(w).max()):  # singular (no L2 share)
                return w
            crossing = (w[on] != 0) & (np.sign(w[on] + way) != np.sign(w[on]))
            stops = np.unique(np.r_[-w[on][crossing] / way[crossing], 1.0])
            curve, down = way @ a @ way, -way @ slope[on]
            value = [t * down + t * t * curve / 2 + l1 * np.abs(w[on] + t * way).sum() for t in stops]
            t = stops[int(np.argmin(value))]
            moved = w[on] + t * way
            moved[crossing] = np.where(-w[on][crossing] / way[crossing] == t, 0.0, moved[crossing])
            w[on] = moved
        return w

    slope = g.xy - g.xx @ w
    for k in range(sweeps):
        for j in free:
            c = slope[j] + g.xx[j, j] * w[j]
            new = np.sign(c) * max(abs(c) - l1, 0.0) / diag[j]
            if new != w[j]:
                slope -= g.xx[:, j] * (new - w[j])
                w[j] = new
        if k % 10 == 9 or k == sweeps - 1:
            exact = polished(w)
            if violation(exact) <= 1e-10:
                return exact, g.intercept(exact)
            if violation(w) <= 1e-12:
                break
            if k == 199:  # slow
                exact = stepped(w)
                if violation(exact) <= 1e-10:
                    return exact, g.intercept(exact)
            slope = g.xy - g.xx @ w
    if violation(w) > 1e-6:
        raise RuntimeError("the elastic net did not converge")
    return w, g.intercept(w)


def as_model(df: DataFrame, w: np.ndarray, intercept: float, features: str, prediction: str) -> LinearRegressionModel:
    """A Spark ML linear model with the given coefficients."""
    from pyspark.ml.common import _py2java
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.util import Identifiable

    sc = df.sparkSession.sparkContext
    uid = f"{LinearRegressionModel.__name__}_{Identifiable()._randomUID().split('_')[-1]}"
    java = sc._jvm.org.apache.spark.ml.regression.LinearRegressionModel(uid, _py2java(sc, Vectors.dense(w)), float(intercept))
    model = LinearRegressionModel(java)
    model._resetUid(uid)
    return model.setFeaturesCol(features).setPredictionCol(prediction)


def fold_predictions(df: DataFrame, features: str, fold: str, models: dict[int, list[tuple[np.ndarray, float]]]) -> Column:
    """``array<double>``: the predictions of all models of the row's fold."""
    held = df.sparkSession.sparkContext.broadcast({f: (np.stack([w for w, _ in m], axis=1), np.array([b for _, b in m]))
                                                   for f, m in models.items()})

    @F.pandas_udf("array<double>")
    def run(x: pd.Series, f: pd.Series) -> pd.Series:
        z, out = np.stack(x.to_numpy()), [None] * len(x)
        for one in f.unique():
            at = np.flatnonzero(f.to_numpy() == one)
            w, b = held.value[int(one)]
            for i, p in zip(at, z[at] @ w + b):
                out[i] = p
        return pd.Series(out)

    return run(vector_to_array(features), F.col(fold).cast("int"))


def cross_validate(train: DataFrame, features: str, label: str, fold: str, width: int, solve, values: list[float], metric
                   ) -> tuple[list[float], Gram]:
    """Mean over folds of ``metric(prediction, label)`` for every value, and the
    Gram table of all rows.  ``solve(gram, value)`` gives (w, b); two passes in all."""
    tables = gram_tables(train, features, label, width, fold)
    models = {f: [solve(without_fold(tables, f), v) for v in values] for f in tables}
    scored = train.select(label, fold, fold_predictions(train, features, fold, models).alias("p"))
    rows = scored.groupBy(fold).agg(*[metric(F.col("p")[i], label).alias(f"s{i}") for i in range(len(values))]).collect()
    means = [float(np.mean([r[f"s{i}"] for r in rows])) for i in range(len(values))]
    return means, Gram.of(sum(tables.values()))
