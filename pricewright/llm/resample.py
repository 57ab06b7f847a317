"""Importance resampling towards a target distribution, by hashed n-grams.

Features of a text are its runs of 1 to 3 consecutive words, joined by a space;
a feature's bucket is its CRC-32 modulo ``BUCKETS``.  The bucket totals of the
raw documents and of the target texts give each bucket a gain; a document's
weight is the sum of its features' gains; Gumbel noise, drawn from a hash of the
id, turns the weights into a draw without replacement.

**Head and tail.**  The most frequent words are broadcast with the exact CRC
states of the word and of the word after a space, the most frequent pairs with
their exact CRC and bucket.  CRC-32 is linear, so the CRC of a run of head words
follows from the states: shift the CRC of the first words by the length of the
last, and add the last word's.  A feature that ends with a word outside the head
takes the CRC of its bytes, on from the register of the words before.  Both ways
give the same number; the head only decides how fast.  It is found over all documents: each task counts words and pairs in
bounded counters, the counts are summed by Spark.

Bounds: ``HEAD`` words and ``HEAD`` pairs are broadcast; a task counts ``HELD``
items at a time; bucket totals are ``BUCKETS`` numbers a task.  Long texts are
read slice by slice, with the last two words carried over.  Ranks are given by a
range partitioning and one offset a partition, never in one task; equal rows are
told apart by a row number, so a hot group spreads over the ranges.

Edge cases: null text has no words, weight 0 and no rank; a null id draws its
noise as ``42:null`` and comes last among equal scores; rows that share an id
share their noise; repeated rows are ranked one after the other; an empty target
or an empty table of documents works (all buckets then have the gain that the
formula gives); columns named like the results are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, filled, small_batches

BUCKETS = 10_000
LONGEST = 3  # words of a feature
HEAD = 1 << 16
HELD = 1 << 18
#: Head words are no longer than this many bytes: one shift table a length.
HEAD_BYTES = 62
SLICE = 1 << 20
CHUNK = 1 << 17  # words that are hashed together

#: Bytes of words stay (A-Z in lower case), all others become a space.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_slices(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, in slices that end between words."""
    data, at = (text or "").encode("utf-8", "replace").translate(BYTES), 0
    while at < len(data):
        to = data.find(b" ", at + SLICE)
        to = len(data) if to < 0 else to
        yield data[at:to].split()
        at = to


def chunks(texts) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(words, text number, words before it) of many texts, about ``CHUNK`` words
    at a time.  The second slice of a text starts with the last two words of the
    first, numbered -1: they are context and no features end there."""
    words: list[bytes] = []
    owner: list[np.ndarray] = []
    before: list[np.ndarray] = []
    held = LONGEST - 1
    for k, text in enumerate(texts):
        context: list[bytes] = []
        for part in word_slices(text):
            words += context
            words += part
            n, c = len(part), len(context)
            owner.append(np.concatenate([np.full(c, -1), np.full(n, k)]))
            before.append(np.minimum(np.arange(c + n), held))
            context = (context + part)[-held:]
            if len(words) >= CHUNK:
                yield words, np.concatenate(owner), np.concatenate(before)
                words, owner, before = [], [], []
    if words:
        yield words, np.concatenate(owner), np.concatenate(before)


def shift_tables(longest: int) -> np.ndarray:
    """[length, byte of the CRC, its value]: the CRC after so many zero bytes,
    without the register's start and end values (the linear part)."""
    poly = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        poly = np.where(poly & 1, np.uint32(0xEDB88320) ^ (poly >> 1), poly >> 1).astype(np.uint32)
    out = np.empty((longest + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, longest + 1):
        out[n] = poly[out[n - 1] & 255] ^ (out[n - 1] >> 8)
    return out


def shifted(tables: np.ndarray, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    return (tables[length, 0, crc & 255] ^ tables[length, 1, (crc >> 8) & 255]
            ^ tables[length, 2, (crc >> 16) & 255] ^ tables[length, 3, crc >> 24])


class Head:
    """Frequent words with their CRC states, frequent pairs with CRC and bucket."""

    def __init__(self, words: list[bytes], pairs: list[bytes]):
        words = [w for w in words if len(w) <= HEAD_BYTES]
        self.ids = {w: k for k, w in enumerate(words)}
        # the last row stands for unseen words (id -1)
        self.crc = np.array([zlib.crc32(w) for w in words] + [0], np.uint32)
        self.spaced = np.array([zlib.crc32(b" " + w) for w in words] + [0], np.uint32)
        self.length = np.array([len(w) + 1 for w in words] + [0], np.int64)
        self.bits = max(1, 2 * len(pairs)).bit_length()
        self.pair = np.full(1 << self.bits, -1, np.int64)
        self.pair_crc = np.zeros(1 << self.bits, np.uint32)
        self.pair_bucket = np.zeros(1 << self.bits, np.int64)
        for p in pairs:  # the most frequent first; a later one whose place is taken is combined from its words
            a, b = (self.ids.get(w) for w in p.split(b" "))
            if a is not None and b is not None:
                key = a * len(self.ids) + b
                at = int(self.place(np.array([key]))[0])
                if self.pair[at] < 0:
                    self.pair[at], self.pair_crc[at] = key, zlib.crc32(p)
                    self.pair_bucket[at] = zlib.crc32(p) % BUCKETS

    def place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)


class Buckets:
    """Buckets of all features, in a task."""

    def __init__(self, head: Head):
        self.head, self.tables = head, shift_tables(HEAD_BYTES + 1)

    def of(self, words: list[bytes], before: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places of the last words, buckets) for features of 1, 2 and 3 words."""
        h, n = self.head, len(words)
        ids = np.fromiter(map(h.ids.get, words, repeat(-1)), np.int64, n)
        tail = np.flatnonzero(ids < 0)
        unseen = [words[i] for i in tail]
        crc = h.crc[ids]  # of the feature that ends here
        crc[tail] = [zlib.crc32(w) for w in unseen]
        yield np.arange(n), (crc % BUCKETS).astype(np.int64)
        unseen = [b" " + w for w in unseen]
        length, spaced = h.length[ids], h.spaced[ids]
        for more in range(1, LONGEST):
            # head words by their states; an unseen word directly, on from the register of the words before it
            longer = np.zeros(n, np.uint32)
            longer[1:] = shifted(self.tables, crc[:-1], length[1:]) ^ spaced[1:]
            longer[tail] = [zlib.crc32(w, c) for w, c in zip(unseen, crc[tail - 1].tolist())]
            bucket = (longer % BUCKETS).astype(np.int64)
            if more == 1 and n > 1:
                key = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * len(h.ids) + ids[1:], -2)
                at = h.place(key)
                hit = np.flatnonzero(h.pair[at] == key)
                longer[hit + 1], bucket[hit + 1] = h.pair_crc[at[hit]], h.pair_bucket[at[hit]]
            last = np.flatnonzero(before >= more)
            yield last, bucket[last]
            crc = longer


def _pruned(held: Counter) -> Counter:
    """At most half of ``HELD`` items, the most frequent ones."""
    least = 1
    while 2 * len(held) > HELD:
        held = Counter({k: n for k, n in held.items() if n > least})
        least *= 2
    return held


def _count_head(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words: Counter = Counter()
    pairs: Counter = Counter()
    for b in batches:
        for text in b["text"]:
            for part in word_slices(text):
                words.update(part)
                pairs.update(zip(part, part[1:]))
                words = _pruned(words) if len(words) > HELD else words
                pairs = _pruned(pairs) if len(pairs) > HELD else pairs
    for kind, held in ((1, words), (2, pairs)):
        top = sorted(held.items(), key=lambda x: (-x[1], x[0]))[:HEAD]
        yield pd.DataFrame({"kind": kind, "item": [k if kind == 1 else b" ".join(k) for k, _ in top],
                            "n": [n for _, n in top]})


def find_head(docs: DataFrame, size: int = HEAD) -> Head:
    """The most frequent words and pairs of all documents."""
    small_batches(docs.sparkSession)
    counts = docs.select(filled().alias("text")).mapInPandas(_count_head, "kind int, item binary, n long")
    summed = cut_lineage(counts.groupBy("kind", "item").agg(F.sum("n").alias("n")))

    # A top-k would send k rows a partition to the driver.  Counts are binned instead
    # (64 bins a doubling), and the highest bins that hold ``size`` items at most are taken.
    level = F.floor(F.log2("n") * 64).cast("int")
    bins = summed.groupBy("kind", level.alias("level")).agg(F.count("*").alias("n")).collect()

    def top(kind: int) -> list[bytes]:
        held, least = 0, 1 << 30
        for r in sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["level"]):
            held += r["n"]
            if held > size:
                break
            least = r["level"]
        rows = summed.filter((F.col("kind") == kind) & (level >= least)).select("item", "n").collect()  # ``size`` at most
        return [bytes(r["item"]) for r in sorted(rows, key=lambda r: (-r["n"], r["item"]))]

    return Head(top(1), top(2))


def bucket_totals(texts: DataFrame, head) -> np.ndarray:
    """Exact features by bucket over the column ``text`` (``head``: a broadcast)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashing, total = Buckets(head.value), np.zeros(BUCKETS, np.int64)
        for b in batches:
            for words, owner, before in chunks(b["text"]):
                for last, bucket in hashing.of(words, before):
                    total += np.bincount(bucket[owner[last] >= 0], minlength=BUCKETS)
        full = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": full, "n": total[full]})

    rows = texts.select(filled().alias("text")).mapInPandas(count, "bucket int, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    s_all, t_all = float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + BUCKETS) / ((float(s) + 1) * (t_all + BUCKETS))))
                     for s, t in zip(raw, target)], np.int64)


def weigh(texts, hashing: Buckets, gain: np.ndarray) -> pd.DataFrame:
    """(n_words, n_features, weight) of each text."""
    n = len(texts)
    counts, weight = np.zeros((2, n), np.int64), np.zeros(n, np.int64)
    for words, owner, before in chunks(texts):
        for length, (last, bucket) in enumerate(hashing.of(words, before)):
            own = owner[last] >= 0
            at, value = owner[last][own], gain[bucket[own]]
            found = np.bincount(at, minlength=n)
            counts[1] += found
            counts[0] += found if length == 0 else 0
            # whole numbers far below 2**53: the sums are exact
            weight += np.bincount(at, weights=value, minlength=n).astype(np.int64)
    return pd.DataFrame({"n_words": counts[0], "n_features": counts[1], "weight": weight})


@F.pandas_udf(T.LongType())
def gumbel(h: pd.Series) -> pd.Series:
    return pd.Series([math.floor(-1000 * math.log(-math.log((x + 0.5) / 4294967296))) for x in h], dtype="int64")


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """The rows with ``rank0`` (0, 1, 2 ... in that order; equal rows one after
    the other).  A row's number in its range partition plus the rows of the
    ranges before; only one count a range reaches the driver."""
    numbered = rows.withColumn("__salt", F.xxhash64(F.monotonically_increasing_id()))
    by = [*order, F.col("__salt")]
    placed = cut_lineage(numbered.repartitionByRange(*by).sortWithinPartitions(*by)
                         .withColumn("__at", F.monotonically_increasing_id()).drop("__salt"))
    part, within = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("n")).collect()
    offsets, at = [], 0
    for r in sorted(sizes):
        offsets.append((r["__part"], at))
        at += r["n"]
    start = rows.sparkSession.createDataFrame(offsets or [(0, 0)], "__part long, __first long")  # a row a partition
    return (placed.withColumn("__part", part).join(F.broadcast(start), "__part")
            .withColumn("rank0", F.col("__first") + within).drop("__at", "__part", "__first"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
             head_size: int = HEAD, keep: list[str] | None = None) -> DataFrame:
    """The documents' columns (those of ``keep``, all by default: they travel
    with the ranks) with ``n_features``, ``weight``, ``score`` and
    ``rank``: the floor(percent * N / 100) highest scores of the N documents of
    at least ``least_words`` words, numbered from 1; null for all others."""
    spark = docs.sparkSession
    small_batches(spark)
    head = spark.sparkContext.broadcast(find_head(docs, head_size))  # 2 * head_size entries at most
    gain = gains(bucket_totals(docs, head), bucket_totals(target, head))

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weighed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashing = Buckets(head.value)
        for texts in batches:
            yield weigh(texts, hashing, gain)

    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"), 256)
    names = [c for c in keep or docs.columns if c.lower() not in ("n_features", "weight", "score", "rank")]
    # the input row travels as one struct, so no name of it can clash with a helper's
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").alias("id"),
                       gumbel(F.conv(F.substring(drawn, 1, 8), 16, 10).cast("long")).alias("noise"), weighed(filled()).alias("w"))
    rows = cut_lineage(rows.select("row", "id", (F.col("w.n_words") >= least_words).alias("eligible"), "w.n_features", "w.weight",
                                   (F.col("w.weight") + F.col("noise")).alias("score")))
    quota = rows.filter("eligible").count() * percent // 100
    out = ranked(rows, [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features")])
    rank = F.when(F.col("eligible") & (F.col("rank0") < quota), F.col("rank0") + 1)
    return out.select(*[F.col("row").getField(c).alias(c) for c in names], "n_features", "weight", "score", rank.alias("rank"))


def resample_digest(docs: DataFrame, target: DataFrame) -> DataFrame:
    """One row a document: features, weight, score and rank."""
    return resample(docs.select("doc_id", "text"), target.select("text"), keep=["doc_id"]).select(
        "doc_id", "n_features", "weight", "score", "rank")
