"""Tree ensembles as ``pyspark.ml`` estimators (rows 75, 76) on histogram trees."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting as B


def vector_width(df: DataFrame, col: str) -> int:
    """Length of a vector column, by its first row (0 without rows)."""
    row = df.select(col).filter(F.col(col).isNotNull()).first()
    return len(row[0]) if row else 0


class TreeEnsemble(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """A boosted model or forest that grows by a ``TreeSpec``."""

    @keyword_only
    def __init__(self, *, spec: B.TreeSpec | None = None, featuresCol: str = "fv", labelCol: str = "price",
                 predictionCol: str = "prediction"):
        super().__init__()
        self.spec = spec or B.TreeSpec()
        self._setDefault(featuresCol="fv", labelCol="price", predictionCol="prediction")
        kw = {k: v for k, v in self._input_kwargs.items() if k != "spec"}
        self._set(**kw)

    def table(self, df: DataFrame, fold: str | None = None, row_id: str = "sample_id") -> B.Binned:
        """The binned table; without the id column rows draw by their content."""
        if row_id not in df.columns:
            df = df.withColumn(row_id, F.xxhash64(vector_to_array(self.getFeaturesCol()), self.getLabelCol()))
        return B.bin_table(df, self.getFeaturesCol(), self.getLabelCol(), vector_width(df, self.getFeaturesCol()), fold, row_id)

    def wrap(self, model: B.TreeModel) -> TreeEnsembleModel:
        out = TreeEnsembleModel(model, self.spec)
        return out._set(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), predictionCol=self.getPredictionCol())

    def _fit(self, df: DataFrame) -> TreeEnsembleModel:
        return self.wrap(B.train(df.sparkSession, self.table(df), {("m", -1): self.spec})["m", -1])


class TreeEnsembleModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, MLWritable):
    def __init__(self, model: B.TreeModel | None = None, spec: B.TreeSpec | None = None):
        super().__init__()
        self.model, self.spec = model, spec
        self._setDefault(featuresCol="fv", labelCol="price", predictionCol="prediction")

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.model.importances())

    def _transform(self, df: DataFrame) -> DataFrame:
        # bounded by the trees of the model, not by rows
        held = df.sparkSession.sparkContext.broadcast(self.model)

        @F.pandas_udf("double")
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                yield pd.Series(held.value.predict(np.stack(x.to_numpy())) if len(x) else np.zeros(0))

        return df.withColumn(self.getPredictionCol(), predict(vector_to_array(self.getFeaturesCol())))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()

    @classmethod
    def load(cls, path: str) -> TreeEnsembleModel:
        return cls.read().load(path)


class _Writer(MLWriter):
    """Parameters as ML metadata; trees and bin edges as parquet tables."""

    def __init__(self, model: TreeEnsembleModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model.model, SparkSession.getActiveSession()
        extra = {"spec": asdict(self.model.spec), "base": m.base, "mean": m.mean}
        DefaultParamsWriter.saveMetadata(self.model, path, spark.sparkContext, {"ensemble": json.dumps(extra)})
        nodes = [(k, j, int(t.feature[j]), int(t.bin[j]), int(t.left[j]), int(t.right[j]), float(t.value[j]), float(t.gain[j]))
                 for k, t in enumerate(m.trees) for j in range(len(t.value))]
        spark.createDataFrame(nodes, "tree int, node int, feature int, bin int, left int, right int, value double, gain double"
                              ).coalesce(1).write.parquet(f"{path}/trees")
        spark.createDataFrame([(j, e.tolist()) for j, e in enumerate(m.edges)], "feature int, edges array<double>"
                              ).coalesce(1).write.parquet(f"{path}/edges")


class _Reader(MLReader):
    def load(self, path: str) -> TreeEnsembleModel:
        spark = SparkSession.getActiveSession()
        meta = DefaultParamsReader.loadMetadata(path, spark.sparkContext)
        extra = json.loads(meta["ensemble"])
        edges = [np.array(r["edges"], float) for r in spark.read.parquet(f"{path}/edges").orderBy("feature").collect()]
        pdf = spark.read.parquet(f"{path}/trees").toPandas().sort_values(["tree", "node"])
        trees = [B.Tree(*[t[c].to_numpy() for c in ("feature", "bin", "left", "right", "value", "gain")])
                 for _, t in pdf.groupby("tree", sort=True)]
        out = TreeEnsembleModel(B.TreeModel(extra["base"], trees, edges, extra["mean"]), B.TreeSpec(**extra["spec"]))
        DefaultParamsReader.getAndSetParams(out, meta)
        return out


def fit_folds(train: DataFrame, members: dict[str, TreeEnsemble], fold_col: str | None, folds: list[int]
              ) -> dict[tuple[str, int], TreeEnsembleModel]:
    """Every member without each of the folds (-1: on all rows), trained together:
    features are binned once, and all learners share each level's job."""
    first = next(iter(members.values()))
    table = first.table(train, fold_col)
    got = B.train(train.sparkSession, table, {(n, f): m.spec for n, m in members.items() for f in folds})
    return {(n, f): members[n].wrap(m) for (n, f), m in got.items()}
