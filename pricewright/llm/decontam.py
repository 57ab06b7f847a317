"""Benchmark decontamination by winnowing (DataFrame operations only).

A window is ``WINDOW`` consecutive item words; an item with fewer words is one
window.  For windows of m words, k-grams are hashed and each window keeps the
smallest hash among its w = m - k + 1 grams, on both sides.  Equal windows keep
equal hashes, so every shared window has a shared fingerprint.

1. Fingerprints of the documents are joined with those of the items; what is
   left is a small table of (text key, shared hashes).
2. Only texts with a shared hash are read again.  A hit is extended to every
   window that kept it, and joined with the item windows word for word, so a
   hash collision cannot make a false hit.
3. Hit words are the union of the matched windows of a text.

Work is keyed by the digest of the text: copies meet in the map-side
aggregation, and repeated or null ids need no care.

Edge cases: null text has no words; a null item id counts as the empty string;
items without words match nothing; items that share an id count once; an empty
benchmark leaves all documents clean; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, filled, text_key, with_columns_of

WINDOW = 13
#: All but \x00-\x2F, \x3A-\x60 and \x7B-\x7F, as ranges that the JVM's patterns
#: test several times faster than the negated class.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
CASED_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"  # before A-Z are lower-cased
#: Rows of the broadcast that prunes the second reading, at most.
BUCKETS = 1 << 17


def words() -> Column:
    """Words, with A-Z (and no other letter) in lower case."""
    lowered = F.translate(filled(), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def n_words() -> Column:
    return F.regexp_count(filled(), F.lit(CASED_WORD)).cast("long")


def once(array: Column, use) -> Column:
    """``use(array)`` with the array computed once: a lambda that holds the
    expression itself would compute it again for each element."""
    return F.transform(F.array(array), use)[0]


def gram_length(m: int) -> int:
    return min(m, (m + 1) // 2 + 1)


def _kept(w: Column, m: int) -> Column:
    """Of each window of m words, in order: the smallest hash of its grams."""
    k = gram_length(m)
    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - k + 1),
                         lambda i: F.xxhash64(F.lit(m), F.slice(w, i, k)))
    if m == k:
        kept = hashes
    else:
        kept = once(hashes, lambda h: F.transform(F.sequence(F.lit(1), F.size(w) - m + 1),
                                                  lambda s: F.array_min(F.slice(h, s, m - k + 1))))
    return F.when(F.size(w) >= m, kept).otherwise(F.array().cast("array<bigint>"))


def fingerprints(lengths: list[int]) -> Column:
    """Distinct kept hashes of a text, for windows of the given lengths."""
    return F.array_distinct(once(words(), lambda w: F.concat(*[_kept(w, m) for m in lengths])))


def _joined_window(w: Column, s: Column, m) -> Column:
    return F.array_join(F.slice(w, s, m), " ")


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item, m, window, hash) for each window of each item."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words().alias("w"))
    out = None
    for m in range(1, WINDOW + 1):
        own = items.filter(F.size("w") >= m if m == WINDOW else F.size("w") == m)
        one = own.select("item", F.explode(F.arrays_zip(
            F.transform(F.sequence(F.lit(1), F.size("w") - m + 1), lambda s: _joined_window(F.col("w"), s, m)).alias("window"),
            _kept(F.col("w"), m).alias("hash"))).alias("x"))
        one = one.select("item", F.lit(m).alias("m"), F.col("x.window").alias("window"), F.col("x.hash").alias("hash"))
        out = one if out is None else out.union(one)
    return out.distinct()


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents with ``__key`` (digest of the text), ``__n_words``,
    ``__n_hit`` and ``__items`` (sorted ids)."""
    items = cut_lineage(item_windows(benchmark))
    lengths = sorted(r["m"] for r in items.select("m").distinct().collect())  # 13 values at most
    keyed = with_columns_of(docs, __key=F.unhex(text_key()))
    if not lengths:
        return with_columns_of(keyed, __n_words=n_words(), __n_hit=F.lit(0).cast("long"),
                               __items=F.array().cast("array<string>"))
    shared = (keyed.select("__key", F.explode(fingerprints(lengths)).alias("hash"))
              .join(items.select("hash").distinct(), "hash", "left_semi")
              .groupBy("__key").agg(F.collect_set("hash").alias("__shared")))
    shared = cut_lineage(shared)

    bucket = F.pmod(F.xxhash64("__key"), F.lit(BUCKETS))
    near = shared.select(bucket.alias("__bucket")).distinct()  # BUCKETS rows at most
    again = (keyed.select("__key", "text").withColumn("__bucket", bucket)
             .join(F.broadcast(near), "__bucket", "left_semi").join(shared, "__key"))

    def extended(w: Column, m: int) -> Column:
        return once(_kept(w, m), lambda kept: F.transform(
            F.filter(F.sequence(F.lit(1), F.size(kept)),
                     lambda s: F.array_contains(F.col("__shared"), F.element_at(kept, s))),
            lambda s: F.struct(s.alias("s"), F.lit(m).alias("m"), _joined_window(w, s, m).alias("window"))))

    windows = again.select("__key", F.explode(once(words(), lambda w: F.concat(*[
        F.when(F.size(w) >= m, extended(w, m)).otherwise(F.array().cast("array<struct<s:int,m:int,window:string>>"))
        for m in lengths]))).alias("x")).select("__key", "x.s", "x.m", "x.window")
    hits = windows.join(items.select("m", "window", "item"), ["m", "window"])
    spans = F.array_sort(F.collect_set(F.struct("s", "m")))
    found = hits.groupBy("__key").agg(spans.alias("spans"), F.array_sort(F.collect_set("item")).alias("__items"))
    # union of the spans: each adds what lies beyond the end so far
    n_hit = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(F.greatest(a["end"], x["s"] + x["m"]).alias("end"),
                              (a["n"] + F.greatest(F.lit(0), x["s"] + x["m"] - F.greatest(a["end"], x["s"]))).alias("n")),
        lambda a: a["n"])
    found = found.select("__key", n_hit.alias("__n_hit"), "__items")
    return (with_columns_of(keyed, __n_words=n_words()).join(found, "__key", "left")
            .withColumn("__n_hit", F.coalesce("__n_hit", F.lit(0).cast("long")))
            .withColumn("__items", F.coalesce("__items", F.array().cast("array<string>"))))


def contaminated() -> Column:
    """The rule: at least one hit word, and one in twenty of all words."""
    return (F.col("__n_hit") > 0) & (20 * F.col("__n_hit") >= F.col("__n_words"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that the rule does not name.  Texts are not shuffled while
    the digests of the contaminated ones are few enough to be broadcast."""
    named = contamination(docs.select("text"), benchmark).filter(contaminated()).select("__key").distinct()
    left = with_columns_of(docs, __key=F.unhex(text_key())).join(cut_lineage(named), "__key", "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row a document: hit words, and the items that hit it."""
    # the text itself is not carried through the joins
    rows = contamination(docs.select("doc_id", "text"), benchmark)
    return rows.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"),
                       F.size("__items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("__items", ",").cast("binary"), 256).alias("items_sha256"),
                       contaminated().alias("contaminated"))
