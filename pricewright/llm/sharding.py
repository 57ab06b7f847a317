"""Sharding by sampled splitters.

Records are ordered by (md5 of the text, doc_id), so equal texts lie side by
side.  Rows that agree in both are counted together.  A size-weighted sample of
keys gives quantile boundaries of many small ranges; the exact bytes of every
range are counted; ranges that hold more than twice their share are divided
again by a sample of their own.  Inside a range rows are numbered in key order;
range offsets turn this into global running bytes and row numbers, from which
shard and slot follow.  A hot group of copies spreads over many ranges, because
doc_id is part of the key.  Rows that agree in text and id and alone are more
than twice a range's share get a range of their own, and are numbered partition
by partition of a stored table: no task holds more of them than one partition.

Edge cases: a null text has size 1 and the key of an empty text; a null doc_id
sorts first; rows that agree in text and id are interchangeable; an empty table
gives an empty result; input columns named like the results are replaced.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import MIN_LONG, cut_lineage, filled, text_key, uniform, with_columns_of

SEED = "shard"
#: Sampled keys for each range, and rounds in which overfull ranges are divided.
KEYS_PER_RANGE = 16
ROUNDS = 4


def byte_size() -> Column:
    return (F.octet_length(filled()) + 1).cast("long")


def range_of(splitters: list[tuple[str, int]]):
    @F.pandas_udf("int")
    def find(key: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(splitters, kt) for kt in zip(key, tie)], dtype="int32")

    return find(F.col("__key"), F.col("__tie"))


def size_weighted_sample(keys: DataFrame, n: int) -> list[tuple[str, int, int]]:
    """n keys, with their bytes, drawn by bytes without replacement: the n first
    arrivals of an exponential race whose rates are the bytes."""
    u = (uniform(SEED, F.col("__key").cast("string"), F.col("__tie").cast("string")) + F.lit(2.0**-53))
    first = keys.select("__key", "__tie", "__bytes", (-F.log(u) / F.col("__bytes")).alias("__at"))
    first = first.orderBy("__at", "__key", "__tie").limit(n).select("__key", "__tie", "__bytes")
    return sorted(tuple(r) for r in first.collect())


def quantiles(keys: list, n: int) -> list:
    return sorted({keys[len(keys) * i // n] for i in range(1, n)}) if keys else []


def apart(drawn: list[tuple[str, int, int]], most: float) -> set[tuple[str, int]]:
    """Boundaries around each key of more than ``most`` bytes."""
    return {(key, tie + d) for key, tie, size in drawn if size > most for d in (0, 1)}


def splitters_for(keys: DataFrame, n_ranges: int) -> tuple[list[tuple[str, int]], list[tuple[int, int]], list[int]]:
    """Boundaries, (bytes, rows) of each range, and the ranges that hold nothing
    but one hot key.  All that reaches the driver is bounded by the number of
    ranges."""
    share = (keys.agg(F.sum("__bytes")).first()[0] or 0) / n_ranges
    drawn = size_weighted_sample(keys, n_ranges * KEYS_PER_RANGE)
    bounds = sorted({*quantiles([x[:2] for x in drawn], n_ranges), *apart(drawn, 2 * share)})
    for left in reversed(range(ROUNDS)):
        placed = keys.withColumn("__range", range_of(bounds))
        found = {r["__range"]: r for r in placed.groupBy("__range").agg(
            F.sum("__bytes").alias("b"), F.sum("__rows").alias("n"), F.count(F.lit(1)).alias("keys"),
            F.min(F.struct("__key", "__tie")).alias("lo")).collect()}
        over = {k: r for k, r in found.items() if r["b"] > 2 * share and r["keys"] > 1}
        if not over or not left:
            break
        inside = placed.filter(F.col("__range").isin(list(over)))
        drawn = size_weighted_sample(inside, n_ranges * KEYS_PER_RANGE)
        more = apart(drawn, 2 * share)
        for k, r in over.items():
            own = [x[:2] for x in drawn if bisect_right(bounds, x[:2]) == k and x[:2] > tuple(r["lo"])]
            more |= set(quantiles([tuple(r["lo"]), *own], int(r["b"] // share) + 1)) - {tuple(r["lo"])}
            more |= {own[0]} if own else set()
        if not more - set(bounds):
            break
        bounds = sorted({*bounds, *more})
    hot = [k for k, r in found.items() if r["keys"] == 1 and r["n"] > 1 and r["b"] > 2 * share]
    return bounds, [(found[k]["b"], found[k]["n"]) if k in found else (0, 0) for k in range(len(bounds) + 1)], hot


def hot_places(rows: DataFrame) -> DataFrame:
    """``__before`` and ``__n`` (bytes and rows before a row in its range) where all
    rows of a range are interchangeable: numbered inside each stored partition, on
    from the counts of the partitions before."""
    stored = cut_lineage(rows.withColumn("__part", F.spark_partition_id()))
    upto = Window.partitionBy("__range").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    cells = (stored.groupBy("__range", "__part").agg(F.count(F.lit(1)).alias("__held"))
             .select("__range", "__part", F.coalesce(F.sum("__held").over(upto), F.lit(0)).alias("__prior")))
    inside = F.row_number().over(Window.partitionBy("__range", "__part").orderBy("__row")) - 1
    return (stored.withColumn("__n", inside).join(cells, ["__range", "__part"])
            .withColumn("__n", F.col("__n") + F.col("__prior"))
            .withColumn("__before", F.col("__n") * F.col("__size")).drop("__part", "__prior"))


def shard(docs: DataFrame, n_shards: int, size: Column | None = None, key: Column | None = None) -> DataFrame:
    """The documents with ``size``, ``shard`` (0 to n_shards - 1, sizes near
    equal: a boundary is off by half a record at most) and ``slot`` (gapless
    from 0 in each shard, in key order).  ``size`` and ``key`` default to the
    bytes and the digest of the text; equal keys must have equal sizes."""
    spark = docs.sparkSession
    names = [c for c in docs.columns if c.lower() not in ("size", "shard", "slot")]
    n_ranges = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = with_columns_of(
        docs, __key=text_key() if key is None else key, __tie=F.coalesce(F.col("doc_id").cast("long"), F.lit(MIN_LONG)),
        __size=byte_size() if size is None else size, __row=F.xxhash64(*[F.col(f"`{c}`") for c in names]))
    keys = cut_lineage(keyed.groupBy("__key", "__tie").agg(
        F.max("__size").alias("__size"), F.sum("__size").alias("__bytes"), F.count(F.lit(1)).alias("__rows")))
    bounds, held, hot = splitters_for(keys, n_ranges)
    total = sum(b for b, _ in held)
    offsets, at_b, at_n = [], 0, 0
    for k, (b, n) in enumerate(held):
        offsets.append((k, at_b, at_n))
        at_b, at_n = at_b + b, at_n + n
    start = spark.createDataFrame(offsets, "__range int, __bytes0 long, __rows0 long")  # one row a range
    order = Window.partitionBy("__range").orderBy("__key", "__tie", "__row")
    ranged = keyed.withColumn("__range", range_of(bounds))
    placed = (ranged.filter(~F.col("__range").isin(hot))
              .withColumn("__before", F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, -1)))
              .withColumn("__n", (F.row_number().over(order) - 1).cast("long")))
    if hot:
        placed = placed.unionByName(hot_places(ranged.filter(F.col("__range").isin(hot))))
    placed = (placed.join(F.broadcast(start), "__range")
              .withColumn("__mid", 2 * (F.coalesce("__before", F.lit(0)) + F.col("__bytes0")) + F.col("__size"))
              .withColumn("__at", F.col("__rows0") + F.col("__n"))
              .withColumn("__shard", F.least(F.lit(n_shards - 1),
                                             F.expr(f"__mid * {n_shards} div {max(1, 2 * total)}")).cast("int")))
    # Running bytes start the shards; their first rows are found from counts by range.
    firsts, seen = {}, 0
    for number, rows in sorted(_shard_rows(keys, bounds, offsets, n_shards, total).items()):
        firsts[number] = seen
        seen += rows
    first = spark.createDataFrame(sorted(firsts.items()) or [(0, 0)], "__shard int, __first long")
    return placed.join(F.broadcast(first), "__shard").select(
        *[F.col(f"`{c}`") for c in names], F.col("__size").alias("size"), F.col("__shard").alias("shard"),
        (F.col("__at") - F.col("__first")).alias("slot"))


def _shard_rows(keys: DataFrame, bounds, offsets, n_shards: int, total: int) -> dict[int, int]:
    """Rows of each shard, counted on the keys: the rows of a key are evenly
    spaced, so those before the end of a shard follow by arithmetic."""
    whole = max(1, 2 * total)
    start = keys.sparkSession.createDataFrame(offsets, "__range int, __bytes0 long, __rows0 long")
    order = Window.partitionBy("__range").orderBy("__key", "__tie").rowsBetween(Window.unboundedPreceding, -1)
    mid = 2 * (F.coalesce(F.sum("__bytes").over(order), F.lit(0)) + F.col("__bytes0")) + F.col("__size")
    placed = keys.withColumn("__range", range_of(bounds)).join(F.broadcast(start), "__range").select(
        mid.alias("mid"), F.col("__size").alias("size"), F.col("__rows").alias("rows"))

    def shard_at(x: str) -> Column:
        return F.least(F.lit(n_shards - 1), F.expr(f"({x}) * {n_shards} div {whole}")).cast("int")

    first, last = shard_at("mid"), shard_at("mid + 2 * size * (rows - 1)")
    spread = placed.withColumns({"first": first, "last": last})
    spread = spread.withColumn("s", F.explode(F.sequence("first", "last")))

    def before(s: str) -> Column:
        """Rows of the key in shards below s."""
        inner = F.expr(f"((({whole} * cast({s} as bigint) - 1) div {n_shards}) - mid) div greatest(2 * size, 1) + 1")
        return F.when(F.expr(f"{s} <= first"), F.lit(0)).when(F.expr(f"{s} > last"), F.col("rows")).otherwise(inner)

    n = F.sum(before("s + 1") - before("s"))
    return {r["s"]: r["n"] for r in spread.groupBy("s").agg(n.alias("n")).collect()}


def shard_digest(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """One row a document: where it lies, by the law ``bytes``.  No text is
    shuffled: key, size and crc are taken while scanning."""
    narrow = docs.select("doc_id", byte_size().alias("__bytes"), text_key().alias("__md5"),
                         F.crc32(filled().cast("binary")).alias("text_crc32"))
    out = shard(narrow, n_shards, size=F.col("__bytes"), key=F.col("__md5"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
