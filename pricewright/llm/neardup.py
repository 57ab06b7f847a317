"""Near-duplicate documents by MinHash and a multi-index Hamming join.

1. Every text becomes its set of word shingles and a signature of ``FIELDS``
   MinHash fields of 16 bits.  Texts with equal sets form a class, kept once.
2. Signatures are split into ``CHUNKS`` chunks.  By the pigeonhole principle, two
   signatures that differ in fewer than 2 * CHUNKS fields have a chunk with at
   most one differing field.  So each chunk is indexed once for each field left
   out: all such pairs meet in a bucket.  (At similarity 0.8 the probability
   that a pair meets nowhere is 3e-6, and it falls quickly above.)
3. In each bucket every class is paired with one center (a star, not all pairs).
   Pairs are compared on their full sets, and links joined to components.
4. Where the members of a center still belong to several components, shingles
   that few of them have are told from the common core.  The member with fewest
   rare shingles is the center of a second star.  What is still apart is paired
   if both share enough with the core to be linked by that alone, or if both
   have the same rare shingle in their prefixes.  Other pairs can't reach the
   similarity: every two classes that met in a bucket are in one component, were
   compared, or can't be linked.  The stars lose no link.

Bucket rows and set rows are joined, never gathered, so a hot bucket is split
by the adaptive skew join.  Sets are made again for paired classes only.

Edge cases: a text without words (or null) has no shingles and no link; fewer
words than a shingle make one shingle.  A null doc_id never names a component
that has another id; rows with null id are kept where all ids are null.  Rows
that agree in id and text share their fate.  An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, filled, free_shuffles, mix64, small_batches, text_key, with_columns_of
from .graph import components

CHUNKS, PER_CHUNK = 12, 6
FIELDS = CHUNKS * PER_CHUNK
#: Pairs that differ in more fields are not compared: at similarity 0.8, 36 of
#: 72 fields is 6 standard deviations off.
MAX_DISTANCE = 36
#: Rows of the broadcast that prunes the second reading, at most.
BUCKETS = 1 << 17
HELD = 200_000
BLOCK = 2048
SPACE = re.compile(rb"[\x20\x09-\x0D]")

_draws = mix64(np.arange(1, 2 * FIELDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
MULTIPLY, ADD = _draws[:FIELDS] | np.uint64(1), _draws[FIELDS:]


def word_slices(text: str, size: int = 1 << 22) -> Iterator[list[bytes]]:
    """Lower-cased (A-Z) words of a text, so many bytes at a time."""
    data = text.encode("utf-8", "surrogatepass").lower()  # of bytes: ASCII only
    at = 0
    while at < len(data):
        cut = SPACE.search(data, at + size)
        to = cut.end() if cut else len(data)
        yield data[at:to].split()  # of bytes: ASCII white space only
        at = to


class WordHashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: str, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    parts, tail = [], np.zeros(0, np.uint64)
    n = 0
    for some in word_slices(text):
        n += len(some)
        h = np.concatenate([tail, np.fromiter(map(hashes.__getitem__, some), np.uint64, len(some))])
        tail = h[max(0, len(h) - words + 1):] if words > 1 else h[:0]
        if len(h) >= words:
            parts.append(_rolled(h, words))
    if n and n < words:
        parts.append(_rolled(tail, n))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def _rolled(h: np.ndarray, words: int) -> np.ndarray:
    out = np.full(len(h) - words + 1, words, np.uint64)
    for k in range(words):
        out = mix64(out + h[k:k + len(out)])
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(FIELDS, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        least = np.minimum(least, (shingles[at:at + BLOCK, None] * MULTIPLY + ADD).min(axis=0))
    return (mix64(least) & np.uint64(0xFFFF)).astype("<u2")


def _signed(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for b in batches:
            out = []
            for t in b["__text"]:
                s = shingle_set(t, words, hashes)
                out.append((hashlib.blake2b(s.tobytes(), digest_size=16).digest(), signature(s).tobytes(), len(s))
                           if len(s) else (None, None, 0))
            got = pd.DataFrame(out, columns=["set_key", "sig", "n"])
            yield pd.concat([b[["doc_id", "rid"]].reset_index(drop=True), got], axis=1)
    return run


def _bucketed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(bucket, node) for each chunk and each of its fields left out."""
    for b in batches:
        for at in range(0, len(b), 4096):
            part = b.iloc[at:at + 4096]
            fields = np.frombuffer(b"".join(part["sig"]), "<u2").astype(np.uint64).reshape(-1, CHUNKS, PER_CHUNK)
            out = np.empty((len(part), CHUNKS, PER_CHUNK), np.uint64)
            for left_out in range(PER_CHUNK):
                h = np.broadcast_to(np.arange(CHUNKS, dtype=np.uint64) * np.uint64(PER_CHUNK) + np.uint64(left_out),
                                    out.shape[:2])
                for k in range(PER_CHUNK):
                    if k != left_out:
                        h = mix64((h << np.uint64(16)) ^ (h >> np.uint64(48)) ^ (fields[:, :, k] + np.uint64(1)))
                out[:, :, left_out] = h
            yield pd.DataFrame({"bucket": out.reshape(-1).view(np.int64), "node": np.repeat(part["node"].to_numpy(), FIELDS)})


@F.pandas_udf(T.IntegerType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="int32")
    x, y = (np.frombuffer(b"".join(s), "<u2").reshape(-1, FIELDS) for s in (a, b))
    return pd.Series((x != y).sum(axis=1), dtype="int32")


@F.pandas_udf(T.ArrayType(T.LongType()))
def _lacking(a: pd.Series, b: pd.Series) -> pd.Series:
    """Shingles of b that a lacks."""
    return pd.Series([np.setdiff1d(np.frombuffer(y, "<i8"), np.frombuffer(x, "<i8"), assume_unique=True) for x, y in zip(a, b)],
                     dtype=object)


def _sets(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for b in batches:
            yield pd.DataFrame({"node": b["node"], "shingles": [shingle_set(t, words, hashes).tobytes() for t in b["__text"]]})
    return run


def _row_id() -> Column:
    """Names a row by id and text; only rows that agree in both share it."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text_key()).cast("binary")))


def stored(df: DataFrame) -> DataFrame:
    """Checkpointed; the shuffles that made it are freed."""
    out = cut_lineage(df)
    free_shuffles(out.sparkSession)
    return out


class Finder:
    """The steps over one table of documents (doc_id, text)."""

    def __init__(self, docs: DataFrame, words: int, percent: int):
        small_batches(docs.sparkSession)
        self.words, self.percent = words, percent
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), filled().alias("__text"), _row_id().alias("rid"))
        self.rows = stored(self.docs.mapInPandas(
            _signed(words), "doc_id long, rid binary, set_key binary, sig binary, n long"))
        # one row a class; its representative is the least id, null last
        least = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "rid")).alias("r")
        classes = self.rows.filter("n > 0").groupBy("set_key").agg(F.max("n").alias("n"), F.max("sig").alias("sig"), least)
        self.classes = stored(classes.select(
            F.monotonically_increasing_id().alias("node"), "set_key", "n", "sig", "r.doc_id", "r.rid"))

    def buckets(self) -> DataFrame:
        """(bucket, node, center) of the buckets with several classes.  The
        center is the class that meets most others in all its buckets: in a
        group of edited copies, one near to what all were copied from."""
        rows = self.classes.select("node", "sig").mapInPandas(_bucketed, "bucket long, node long")
        several = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
        met = stored(rows.join(several, "bucket"))
        known = met.groupBy("node").agg(F.sum(F.col("n") - 1).alias("meets"))
        center = met.join(known, "node").groupBy("bucket").agg(F.max(F.struct("meets", (-F.col("node")).alias("x"))).alias("c"))
        return stored(met.select("bucket", "node").join(center.select("bucket", (-F.col("c.x")).alias("center")), "bucket"))

    def near(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that sizes and signatures leave possible."""
        of = lambda c: self.classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}"))
        sized = pairs.join(of("a"), "a").join(of("b"), "b").filter(
            100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b"))
        return stored(sized.filter(_distance("sig_a", "sig_b") <= MAX_DISTANCE).select("a", "b", "n_a", "n_b"))

    def compared(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b, n_a, n_b) with the shingles of b that a lacks, on the full sets.
        Rows that share a rid hold one text: it makes one set, so every pair comes once."""
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = stored(self.classes.join(nodes, "node").select("node", "rid"))
        bucket = F.pmod(F.xxhash64("rid"), F.lit(BUCKETS))
        few = wanted.select(bucket.alias("__bucket")).distinct()  # BUCKETS rows at most
        texts = (self.docs.select("rid", "__text").withColumn("__bucket", bucket)
                 .join(F.broadcast(few), "__bucket", "left_semi").dropDuplicates(["rid"])  # repeats go before the shuffle
                 .join(wanted, "rid").select("node", "__text"))
        sets = texts.mapInPandas(_sets(self.words), "node long, shingles binary")
        of = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}"))
        both = pairs.join(of("b"), "b").join(of("a"), "a").withColumn("rest", _lacking("set_a", "set_b"))
        return stored(both.select("a", "b", "n_a", "n_b", "rest"))

    def linked(self, pairs: DataFrame) -> DataFrame:
        common = F.col("n_b") - F.size("rest")
        return pairs.filter(100 * common >= self.percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b")

    def members(self, rows: DataFrame, links: DataFrame) -> DataFrame:
        """Rows (center, node, ...) of the centers whose members do not belong to
        one component, with the component as ``root``."""
        rows = rows.drop("root").join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = rows.groupBy("center").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("center")
        return stored(rows.join(mixed, "center"))

    def with_rare(self, members: DataFrame) -> DataFrame:
        """Adds ``rare``: the shingles of a member that neither its center nor
        half of the center's members have, rarest first; and ``core``, how many
        others it has."""
        rest = members.select("center", "node", F.explode("rest").alias("shingle"))
        size = members.groupBy("center").agg(F.count("*").alias("members"))
        seen = rest.groupBy("center", "shingle").agg(F.count("*").alias("seen")).join(size, "center").filter("2 * seen <= members")
        rare = rest.join(seen, ["center", "shingle"]).groupBy("center", "node").agg(
            F.array_sort(F.collect_list(F.struct("seen", "shingle"))).alias("rare"))
        rows = members.drop("rest").join(rare, ["center", "node"], "left")
        rows = rows.withColumn("rare", F.coalesce("rare", F.array().cast("array<struct<seen:bigint,shingle:bigint>>")))
        return stored(rows.withColumn("core", F.col("n") - F.size("rare")))

    def links(self) -> DataFrame:
        met = self.buckets()
        n = self.classes.select("node", "n")
        stars = (met.filter("center <> node").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
                 .join(n.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a")
                 .join(n.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b"))
        tried = self.compared(stored(stars))
        links = self.linked(tried)
        rows = tried.select(F.col("a").alias("center"), F.col("b").alias("node"), F.col("n_b").alias("n"), "rest")
        rows = self.with_rare(self.members(rows, links))
        # second star: around the member with fewest rare shingles
        best = rows.groupBy("center").agg(F.min(F.struct(F.size("rare").alias("k"), "node", "root")).alias("best"))
        second = rows.join(best, "center").filter((F.col("node") != F.col("best.node")) & (F.col("root") != F.col("best.root")))
        second = second.select(F.least("node", "best.node").alias("a"), F.greatest("node", "best.node").alias("b")).distinct()
        links = stored(links.union(self.linked(self.compared(self.near(second)))))
        rows = self.members(rows, links)
        side = lambda df, c, *on: df.select(*on, *[F.col(x).alias(f"{x}_{c}") for x in ("node", "root", "n", "core")])
        apart = ((F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b"))
                 & (100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")))
        # Two members that share no rare shingle have no more in common than the lesser core ...
        enough = F.least("core_a", "core_b") * (100 + self.percent) >= self.percent * (F.col("n_a") + F.col("n_b"))
        inner = rows.filter(100 * F.col("core") >= self.percent * F.col("n"))
        by_core = side(inner, "a", "center").join(side(inner, "b", "center"), "center").filter(apart & enough)
        # ... and in an order that has the rare ones first, the first common shingle lies in the prefixes of both.
        prefix = F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1
        outer = rows.withColumn("x", F.explode(F.slice("rare", F.lit(1), prefix.cast("int")))).withColumn("shingle", F.col("x.shingle"))
        by_rare = side(outer, "a", "center", "shingle").join(side(outer, "b", "center", "shingle"), ["center", "shingle"]).filter(apart)
        across = by_core.select("node_a", "node_b").union(by_rare.select("node_a", "node_b")).distinct()
        across = self.near(across.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
        return stored(links.union(self.linked(self.compared(across))))

    def groups(self) -> DataFrame:
        """(doc_id, rid, n, component_id, component rid) of every row."""
        root = components(self.links())
        placed = self.classes.join(root, "node", "left").select(
            "set_key", F.coalesce("root", "node").alias("root"),
            F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "rid").alias("r"))
        heads = placed.groupBy("root").agg(F.min("r").alias("head"))
        placed = placed.join(heads, "root").select("set_key", F.col("head.doc_id").alias("head_id"), F.col("head.rid").alias("head_rid"))
        alone = self.rows.filter("n = 0").select("doc_id", "rid", "n", F.col("doc_id").alias("head_id"), F.col("rid").alias("head_rid"))
        linked = self.rows.filter("n > 0").join(placed, "set_key").select("doc_id", "rid", "n", "head_id", "head_rid")
        return linked.union(alone)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, rid, n, head_id, head_rid): the head is the document that stays."""
    return Finder(docs, words, percent).groups()


def duplicate_digest(docs: DataFrame) -> DataFrame:
    """One row a document: its component by 2-word shingles."""
    g = near_duplicates(docs.select("doc_id", "text"), words=2, percent=80)
    return g.select("doc_id", F.col("n").alias("n_shingles"), F.col("head_id").alias("component_id"),
                    F.col("doc_id").eqNullSafe(F.col("head_id")).alias("kept"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near-duplicates: the least id of each group stays;
    of rows that agree in id and text, one."""
    heads = near_duplicates(docs.select("doc_id", "text"), words, percent).filter(
        F.col("rid") == F.col("head_rid")).groupBy("rid").agg(F.count("*").alias("__n"))
    kept = with_columns_of(docs, __rid=_row_id()).join(heads.withColumnRenamed("rid", "__rid"), "__rid")
    kept = kept.select(*[F.col(f"`{c}`") for c in docs.columns], "__rid", "__n")
    single = kept.filter("__n = 1")
    repeated = kept.filter("__n > 1").dropDuplicates(["__rid"])
    return single.union(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
