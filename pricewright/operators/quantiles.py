"""Exact quantiles of any number of values, one path for every size.

Equal values are counted with map-side aggregation, the counts are
range-partitioned in value order and written to the shared checkpoint folder.
Totals of the partitions (one row a partition and column) tell where each rank
lies; only those partitions are read again to pick the values.  No task holds
more than its range of the distinct values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage


def exact_quantiles(df: DataFrame, cols: list[str | Column], probs: list[float]) -> list[list[float] | None]:
    """For each column its quantiles, linearly interpolated between ranks; None
    for a column without values.  Nulls are left out; NaN is the largest value."""
    if not cols:
        return []
    values = F.array(*[F.struct(F.lit(i).alias("k"), (F.col(c) if isinstance(c, str) else c).cast("double").alias("v"))
                       for i, c in enumerate(cols)])
    counts = (df.select(F.explode(values).alias("x")).select("x.k", "x.v").filter("v is not null")
              .groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")))
    placed = cut_lineage(counts.repartitionByRange("k", "v").withColumn("part", F.spark_partition_id()))
    totals = placed.groupBy("k", "part").agg(F.sum("n").alias("n"), F.min("v").alias("lo")).collect()
    wanted: dict[tuple[int, int], list[tuple[int, int]]] = {}  # (column, global rank) -> part and rank inside
    sizes: dict[int, int] = {}
    for k in range(len(cols)):
        mine = sorted((r for r in totals if r["k"] == k), key=lambda r: (r["lo"] != r["lo"], r["lo"], r["part"]))
        n = sizes[k] = sum(r["n"] for r in mine)
        for rank in {f(p * (n - 1)) for p in probs for f in (math.floor, math.ceil)} if n else ():
            at = 0
            for r in mine:
                if rank < at + r["n"]:
                    wanted[k, rank] = (r["part"], rank - at)
                    break
                at += r["n"]
    if not wanted:
        return [None] * len(cols)
    spark = df.sparkSession
    targets = spark.createDataFrame([(k, part, rank, local) for (k, rank), (part, local) in wanted.items()],
                                    "k int, part int, rank long, local long")  # two a quantile and column
    order = Window.partitionBy("k", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = (placed.join(F.broadcast(targets.select("k", "part").distinct()), ["k", "part"], "left_semi")
            .withColumn("upto", F.sum("n").over(order)))
    hit = (F.col("local") < F.col("upto")) & (F.col("local") >= F.col("upto") - F.col("n"))
    found = {(r["k"], r["rank"]): r["v"] for r in
             upto.join(F.broadcast(targets), ["k", "part"]).filter(hit).select("k", "rank", "v").collect()}

    def at(k: int, p: float) -> float:
        x = p * (sizes[k] - 1)
        lo, hi = found[k, math.floor(x)], found[k, math.ceil(x)]
        return lo if lo == hi else lo + (hi - lo) * (x - math.floor(x))

    return [[at(k, p) for p in probs] if sizes[k] else None for k in range(len(cols))]
