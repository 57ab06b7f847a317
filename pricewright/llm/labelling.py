"""Bounded samples of labelled documents, and the logistic fit the classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .common import filled, fold, uniform


def sample(docs: DataFrame, labels: DataFrame, target: str, held: int, mod: int, most: dict[int, int],
           max_chars: int) -> tuple[list[Row], dict[int, int]]:
    """Labelled documents outside the held-out fold, at most ``most[y]`` of each
    label y (those whose ids draw least) and none longer than ``max_chars``; and
    how many ids have each label.  Conflicting labels of an id count as 1; of
    rows that share an id the least text is taken."""
    y = (labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).filter(fold(mod) != held)
         .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(target).cast("int").alias("y")))
    totals = {r["y"]: r["count"] for r in y.groupBy("y").count().collect()}
    drawn = y.withColumn("__draw", uniform(target, F.col("doc_id").cast("string")))
    ids = []
    for kind, n in most.items():
        ids += drawn.filter(F.col("y") == kind).orderBy("__draw", "doc_id").limit(n).select("doc_id", "y").collect()
    if not ids:
        return [], totals
    chosen = docs.sparkSession.createDataFrame([tuple(r) for r in ids], "doc_id long, y int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), filled().alias("text")).filter(F.char_length("text") <= max_chars)
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect()
    return sorted(rows, key=lambda r: r["doc_id"]), totals


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, intercept: bool = True, steps: int = 50,
             weight: np.ndarray | float = 1.0) -> np.ndarray:
    """Ridge-penalised logistic weights (the intercept last) by Newton's method."""
    if intercept:
        x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    penalty = np.full(x.shape[1], ridge * len(x) + 1e-3)
    if intercept:
        penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(h, x.T @ (weight * (p - y)) + penalty * w)
        w = w - move
        if np.abs(move).max() < 1e-9:
            break
    return w
