"""Visual features joined to items (rows 41, 68).

``visual_join`` is an equi left join on ``sample_id``: the visual table grows
with the data, so no broadcast is forced; AQE turns it into a broadcast join
only when the runtime size of the visual side is small.  Missing vectors become
zeros of the reference width, longer vectors are cut and shorter ones padded,
and ``has_visual`` flags the hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import decompose, scale


def fixed_width(vec, dim: int):
    """Cut to ``dim`` or pad with zeros to ``dim``; null → all zeros."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    cut = F.slice(vec, 1, dim)
    padded = F.concat(cut, F.array_repeat(F.lit(0.0).cast("float"), F.greatest(F.lit(0), F.lit(dim) - F.size(cut))))
    return F.when(vec.isNull(), zeros).otherwise(padded)


def visual_dim(vis: DataFrame) -> int:
    """Width of the visual vectors (the widest one; one tiny aggregate)."""
    return int(vis.agg(F.max(F.size("features"))).first()[0] or 0)


def visual_join(items: DataFrame, vis: DataFrame, dim: int) -> DataFrame:
    v = vis.select("sample_id", F.col("features").alias("_vf"))
    j = items.join(v, "sample_id", "left")
    return j.withColumn("visual", fixed_width(F.col("_vf"), dim)).withColumn(
        "has_visual_flag", F.when(F.col("_vf").isNull(), 0.0).otherwise(1.0)).drop("_vf")


class VisualBlock:
    """Scaler and PCA fitted on the visual table itself, applied to joined items.

    Zero-filled rows of items without a vector go through the same scaler and
    projection, so they become one constant non-zero vector (as in the
    reference); the flag is appended last.
    """

    def __init__(self, vis: DataFrame, dim: int, k: int | None = None):
        self.dim = dim
        self.k = k if k is not None else min(64, max(1, dim // 2), 100)
        fixed = vis.select(fixed_width(F.col("features"), dim).alias("x"))
        self.scaler = scale.fit_standard_array(fixed, "x", dim)
        scaled = fixed.select(self.scaler.column("x").alias("z"))
        self.pca = decompose.fit_pca(scaled, "z", self.k)

    def column(self, visual: str = "visual", flag: str = "has_visual_flag"):
        """Expression form (interpreted; fine for small inputs)."""
        proj = self.pca.column(self.scaler.column(visual))
        return F.concat(proj, F.array(F.col(flag)))

    def apply(self, df: DataFrame, visual: str = "visual", flag: str = "has_visual_flag", out: str = "vis"):
        """Scaled, projected by the compiled PCA transform, flag appended."""
        d = self.pca.transform(df, self.scaler.column(visual), "_pca")
        return d.withColumn(out, F.concat(F.col("_pca"), F.array(F.col(flag)))).drop("_pca")
