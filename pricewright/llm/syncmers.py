"""Document fingerprints from closed syncmers.

A k-mer of K characters is an anchor when the smallest of its S-mers lies at its
first or last place.  Whether a k-mer is chosen depends on its own characters
only, so an unchanged passage keeps its anchors wherever it stands, and two
texts are matched position by position: neighbouring anchors of one that stand
in the other at the same distance bound a passage of both (``passages``).  Every
passage of at least 2K - S characters holds an anchor, so none is missed.  A
fingerprint is the ``KEPT`` smallest distinct anchor hashes (a bottom sketch) in
hex; the likeness of two fingerprints is the share of common hashes among the
smallest of both, which estimates the Jaccard similarity of the anchor sets.

Edge cases: null counts as empty; a text shorter than K has one anchor, itself;
two empty texts are alike (1.0), an empty and another are not (0.0).  Rows that
agree in id and text stand side by side in the order of documents, each being the
next one of the one before; an empty table gives an empty result; further columns
are not read.  Very long texts are hashed block by block; matching holds the
anchors of two texts, about a quarter of their characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIN_LONG, cut_lineage, filled, mix64, text_key
from .sharding import quantiles, range_of, size_weighted_sample

K, S, KEPT = 15, 8, 128
HEX = 10  # hex digits of a hash in a fingerprint: its 40 high bits
BLOCK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _polynomial(c: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n characters, n a power of two, by doubling."""
    h, m, step = c, int(BASE), 1
    while step < n:
        h = h[:-step] * np.uint64(m) + h[step:]
        m, step = m * m % 2**64, step * 2
    return h


def _block_anchors(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of at least K characters."""
    inner = _polynomial(mix64(c.astype(np.uint64) + np.uint64(1)), S)
    order = mix64(inner)
    least, step = order, 1
    while step < K - S + 1:
        least, step = np.minimum(least[:-step], least[step:]), step * 2
    n = len(least)
    at = np.flatnonzero((order[:n] == least) | (order[K - S:K - S + n] == least))
    return at, mix64(inner[at] * BASE + inner[at + K - S])


def anchors(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Anchors of a text, block by block, with their positions."""
    c = code_points(text)
    if 0 < len(c) < K:
        yield np.zeros(1, np.int64), mix64(np.array([hash_of(c)], np.uint64))
    for at in range(0, max(0, len(c) - K + 1), BLOCK):
        where, hashes = _block_anchors(c[at:at + BLOCK + K - 1])
        yield where + at, hashes


def hash_of(c: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(c.tobytes(), digest_size=8).digest(), "little")


def placed(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of all anchors of a text, in order of position."""
    found = list(anchors(text))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([w for w, _ in found]), np.concatenate([h for _, h in found])


def least(hashes: np.ndarray) -> np.ndarray:
    """The smallest distinct hashes (their high bits), in order.  Equal high bits
    are neighbours, so a few more than are kept do, unless many repeat."""
    high = hashes >> np.uint64(64 - 4 * HEX)
    for n in (8 * KEPT, len(high)):
        part = np.partition(high, n)[:n] if n < len(high) else high
        kept = np.unique(part)
        if len(kept) >= KEPT or n >= len(high):
            return kept[:KEPT]
    return kept[:KEPT]


def sketch(text: str) -> np.ndarray:
    """The fingerprint of a text, as numbers."""
    return least(placed(text)[1])


def passages(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Passages of one text, of ``n`` characters, that stand in another: rows
    (start, start in the other, length), in order of position.  Each anchor is
    looked up at its first place in the other text; a passage goes on from anchor
    to anchor as long as both texts keep the same distance, and ends with the last
    anchor's k-mer.  Neighbouring anchors overlap, so passages are equal in every
    character."""
    at, hashes = a
    first, where = np.unique(b[1], return_index=True)
    if not len(at) or not len(first):
        return np.zeros((0, 3), np.int64)
    found = np.minimum(np.searchsorted(first, hashes), len(first) - 1)
    hit = first[found] == hashes
    shift = b[0][where[found]] - at
    goes_on = hit[1:] & hit[:-1] & (shift[1:] == shift[:-1])
    starts = np.flatnonzero(hit & ~np.concatenate([[False], goes_on]))
    ends = np.flatnonzero(hit & ~np.concatenate([goes_on, [False]]))
    to = np.minimum(at[ends] + K, n)
    return np.stack([at[starts], at[starts] + shift[starts], to - at[starts]], axis=1)


def covered(spans: np.ndarray) -> int:
    """Characters inside passages, each counted once."""
    if not len(spans):
        return 0
    ends = np.maximum.accumulate(spans[:, 0] + spans[:, 2])
    before = np.concatenate([[0], ends[:-1]])
    return int(np.maximum(0, ends - np.maximum(spans[:, 0], before)).sum())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:KEPT]
    common = np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)
    return float(common.sum()) / len(both)


def shown(s: np.ndarray) -> str:
    return "".join(f"{x:0{HEX}x}" for x in s.tolist())


def parsed(fingerprint: str) -> np.ndarray:
    return np.array([int(fingerprint[k:k + HEX], 16) for k in range(0, len(fingerprint), HEX)], np.uint64)


def edited(text: str, following: str) -> str:
    """The second half replaced by the beginning of the next document."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """The documents laid out so that each stands before its next one.

    The order is descending doc_id (null last), equal ids by the digest of the
    text; after the last comes the first.  The narrow order keys are split into
    ranges; the first document of each range is also sent, as a tail, to the
    range before it.  So every text is shuffled once, and no task sees more than
    its ranges.  Rows that agree in id and text stand side by side.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), filled().alias("text"),
        # bitwise not turns descending ids into ascending keys without overflow
        F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(-(MIN_LONG + 1))).alias("__key"),
        F.concat(F.when(F.col("doc_id").isNull(), "1").otherwise("0"), text_key()).alias("__tie"))
    narrow = cut_lineage(keyed.select("__key", "__tie", (F.octet_length("text") + 1).cast("long").alias("__bytes")))
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = quantiles([x[:2] for x in size_weighted_sample(narrow, n * 16)], n)
    heads = narrow.withColumn("__range", range_of(bounds)).groupBy("__range").agg(
        F.min(F.struct("__key", "__tie")).alias("h")).orderBy("__range").collect()  # a row for each range
    ranges = [r["__range"] for r in heads]
    plan = spark.createDataFrame(
        [(r["__range"], r["h"]["__key"], r["h"]["__tie"], ranges[k - 1]) for k, r in enumerate(heads)],
        "__range int, __hkey long, __htie string, __prev int")
    places = F.when((F.col("__key") == F.col("__hkey")) & (F.col("__tie") == F.col("__htie")),
                    F.array(F.struct(F.col("__range").alias("to"), F.lit(False).alias("tail")),
                            F.struct(F.col("__prev").alias("to"), F.lit(True).alias("tail")))).otherwise(
        F.array(F.struct(F.col("__range").alias("to"), F.lit(False).alias("tail"))))
    sent = (keyed.withColumn("__range", range_of(bounds)).join(F.broadcast(plan), "__range")
            .withColumn("__place", F.explode(places))
            .select("doc_id", "text", "__key", "__tie", F.col("__place.to").alias("__to"), F.col("__place.tail").alias("__tail")))
    laid = sent.repartition("__to").sortWithinPartitions("__to", "__tail", "__key", "__tie")
    return laid.select("doc_id", "text", "__tail")


DIGEST = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, shared_edited long, shared_next long, longest_next long")


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Emits each document when its next one arrives."""
    held = None  # (doc_id, text, anchors, sketch) of the document that waits
    for b in batches:
        out = []
        for i, text, tail in zip(b["doc_id"].astype("Int64"), b["text"], b["__tail"]):
            if held is None and tail:
                continue  # a second, equal tail
            at = placed(text)
            own = least(at[1])
            if held is not None:
                hid, htext, hat, hown = held
                new = edited(htext, text)
                new_at = placed(new)
                fresh = least(new_at[1])
                in_new, in_next = passages(hat, new_at, len(htext)), passages(hat, at, len(htext))
                out.append((hid, len(htext), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                            shown(hown), shown(fresh), likeness(hown, fresh), likeness(hown, own),
                            covered(in_new), covered(in_next), int(in_next[:, 2].max(initial=0))))
            held = None if tail else (i, text, at, own)
        got = pd.DataFrame(out, columns=[x.split()[0] for x in DIGEST.split(", ")])
        yield got.astype({"doc_id": "Int64"})


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    """One row a document: fingerprints of its text and of its edited text, the
    characters of it in passages of the edited text (``shared_edited``) and of the
    next document (``shared_next``), and the longest of the latter."""
    return with_next(docs.select("doc_id", "text")).mapInPandas(_walk, DIGEST)
