"""Mixing sources to target weights.

Words are summed for each source, targets are filled like connected vessels
(a share by weight, stopped at twice the source's own size, the excess shared
again), and the repetition rate of a source is target / size.  A document is
emitted floor(rate) times, plus once more when a draw seeded by its id and text
falls under the fraction.  Rows that agree in id, text and source share a draw:
of n such rows, n times the fraction, rounded by it, are taken once more.  Draws
depend on nothing else, so reruns agree on any cluster.

Edge cases: a null text has size 0; a null source is a source, ordered last; a
source without words has target 0; an empty table gives an empty result.  How
many of the rows that agree in id, text and source are taken is fixed; which of
them are is not.  The plan has a row for each source and is refused beyond
``max_sources``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_WORD, cut_lineage, filled, text_key, uniform, with_columns_of

SEED = "mix"
WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MAX_REPEAT = 2.0
#: Groups of repeated rows that are broadcast, and parts of a larger join's keys.
MAX_BROADCAST = 200_000
SALTS = 16
PLAN = "__source string, __source_size long, __target double, __rate double"


def targets(sizes: list[int], weights: list[float], total: float, max_repeat: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``max_repeat`` times its size."""
    out: list[float | None] = [None] * len(sizes)
    while True:
        open_ = [k for k, t in enumerate(out) if t is None]
        weight = sum(weights[k] for k in open_)
        left = total - sum(t for t in out if t is not None)
        full = [k for k in open_ if left * weights[k] / weight > max_repeat * sizes[k]]
        for k in full:
            out[k] = max_repeat * sizes[k]
        if not full:
            for k in open_:
                out[k] = left * weights[k] / weight
            return [float(t) for t in out]


def sized(docs: DataFrame) -> DataFrame:
    """The documents with their words, their draw, and a digest of what rows must
    agree in to be interchangeable."""
    same = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text_key())
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    return with_columns_of(
        docs, __size=F.regexp_count(filled(), F.lit(SPACE_WORD)).cast("long"), __draw=uniform(SEED, same),
        __kin=F.md5(F.concat_ws(":", same, source).cast("binary")))


def plan(rows: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE, max_repeat: float = MAX_REPEAT,
         max_sources: int = 1_000_000) -> DataFrame:
    """Size, target and repetition rate of each source."""
    found = rows.groupBy(F.col("source").cast("string").alias("s")).agg(F.sum("__size").alias("n"))
    found = found.limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    found.sort(key=lambda r: (r["s"] is None, (r["s"] or "").encode("utf-8")))  # UTF-8 order is code point order
    sizes = [r["n"] for r in found]
    aims = targets(sizes, [weights[k % len(weights)] for k in range(len(found))], total_share * sum(sizes), max_repeat)
    return rows.sparkSession.createDataFrame(
        [(r["s"], n, t, t / n if n else 0.0) for r, n, t in zip(found, sizes, aims)], PLAN)


def numbered(rows: DataFrame, kin: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """The rows with ``__of``, how many agree with them, and ``__nth``, their place
    among those (from 0).  Only repeated rows are stored and numbered: inside a
    stored partition by a window, and across partitions by their counts, so that a
    hot group is never in one task."""
    repeated = kin.filter(F.col("__of") > 1).select("__kin", "__of")
    n = repeated.count()
    if not n:
        return rows.withColumns({"__of": F.lit(1).cast("long"), "__nth": F.lit(0).cast("long")})
    rows = rows.withColumn("__part", F.spark_partition_id())
    if n <= max_broadcast:
        joined = rows.join(F.broadcast(repeated), "__kin", "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        joined = rows.withColumn("__salt", F.col("__part") % SALTS).join(
            repeated.withColumn("__salt", salts), ["__kin", "__salt"], "left").drop("__salt")
    alone = joined.filter(F.col("__of").isNull()).drop("__part")
    alone = alone.withColumns({"__of": F.lit(1).cast("long"), "__nth": F.lit(0).cast("long")})
    order = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    many = cut_lineage(joined.filter(F.col("__of").isNotNull()).withColumn("__row", order))
    upto = Window.partitionBy("__kin").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    cells = (many.groupBy("__kin", "__part").agg(F.count(F.lit(1)).alias("__held"))
             .select("__kin", "__part", F.coalesce(F.sum("__held").over(upto), F.lit(0)).alias("__prior")))
    inside = F.row_number().over(Window.partitionBy("__kin", "__part").orderBy("__row"))
    many = (many.withColumn("__in", inside).join(cells, ["__kin", "__part"])
            .withColumn("__nth", F.col("__prior") + F.col("__in") - 1).drop("__part", "__row", "__in", "__prior"))
    return alone.unionByName(many)


def copies(docs: DataFrame, max_broadcast: int = MAX_BROADCAST, **settings) -> DataFrame:
    """The documents with ``__copies``, how often the mix takes each, and the
    plan of its source."""
    rows = sized(docs)
    kin = cut_lineage(rows.groupBy("__kin").agg(F.first("source").alias("source"), F.sum("__size").alias("__size"),
                                                F.count(F.lit(1)).alias("__of")))
    source = F.col("source").cast("string")
    joined = numbered(rows, kin, max_broadcast).join(F.broadcast(plan(kin, **settings)), source.eqNullSafe(F.col("__source")))
    share = F.col("__of") * (F.col("__rate") - F.floor("__rate"))
    extra = F.floor(share) + (F.col("__draw") < share - F.floor(share)).cast("int")
    return joined.withColumn("__copies", (F.floor("__rate") + (F.col("__nth") < extra).cast("int")).cast("int"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it."""
    out = copies(docs, **settings).filter(F.col("__copies") > 0)
    out = out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_digest(docs: DataFrame) -> DataFrame:
    """One row a document: its size, its source's size and target, words taken."""
    out = copies(docs.select("doc_id", "text", "source"))
    return out.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                      F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"))
