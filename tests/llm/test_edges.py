"""Every operator on the edge tables: defined results, extra columns, empty input."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.llm import (decontam, langid, mixing, neardup, quality, secret_scan, sharding, syncmers, tokencount,
                             toxicity)

from .conftest import edge_rows

N = len(edge_rows())


def digests(bench, labels):
    return {
        "langid": langid.langid_digest, "decontam": lambda d: decontam.contamination_digest(d, bench),
        "tokens": tokencount.token_digest, "syncmers": syncmers.fingerprint_digest, "neardup": neardup.duplicate_digest,
        "secrets": secret_scan.secret_digest, "toxicity": lambda d: toxicity.toxicity_digest(d, labels),
        "mixing": mixing.mix_digest, "quality": lambda d: quality.quality_digest(d, labels), "sharding": sharding.shard_digest,
    }


NAMES = sorted(digests(None, None))


@pytest.mark.parametrize("name", NAMES)
def test_edges_and_clashing_names(edge, clashing, bench_items, label_rows, name):
    run = digests(bench_items, label_rows)[name]
    plain, more = (sorted(map(repr, run(d).collect())) for d in (edge, clashing))
    assert plain == more
    if name != "secrets":
        assert len(plain) == N


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(empty, bench_items, label_rows, name):
    assert digests(bench_items, label_rows)[name](empty).collect() == []


def test_empty_side_tables(spark, edge, bench_items, label_rows):
    r = decontam.contamination_digest(edge, bench_items.limit(0)).collect()
    assert len(r) == N and not any(x["contaminated"] or x["n_hit"] for x in r)
    for digest in (toxicity.toxicity_digest, quality.quality_digest):
        r = digest(edge, label_rows.limit(0)).collect()
        assert len(r) == N and len({x["score"] for x in r}) == 1


def test_language_of_letterless_texts(edge):
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.langid_digest(edge).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (5, "und"), (None, "und")} <= got
    assert {lang for i, lang in got if i == 6} <= {"en", "fr", "de", "es"}


def test_language_without_labels(spark, edge):
    from pyspark.sql import functions as F

    none = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.langid_digest(none).collect()} == {"und"}


def test_contamination_values(edge, bench_items):
    rows = [r for r in decontam.contamination_digest(edge, bench_items).collect() if r["doc_id"] == -5]
    assert [(r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in rows] == [(9, 6, 2, True)]
    rows = [r for r in decontam.contamination_digest(edge, bench_items).collect() if r["doc_id"] == 1]
    # ids that are null count as the empty string
    assert sorted((r["n_words"], r["n_hit"], r["n_items"]) for r in rows) == [(6, 2, 1), (9, 6, 2), (9, 6, 2)]


def test_shards_have_gapless_slots_and_near_equal_bytes(spark):
    rows = [(k % 700, "same text" if k % 3 == 0 else f"text {k % 500} " + "y" * (k % 90), "en", "a", 0) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sharding.shard_digest(df).collect()
    assert len(got) == 3000
    sizes = np.zeros(8)
    for s in range(8):
        mine = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        sizes[s] = sum(r["size"] for r in mine)
    assert np.abs(sizes - sizes.mean()).max() <= max(r["size"] for r in got)
    assert {r["text_crc32"] for r in got if r["size"] == 10} >= {zlib.crc32(b"same text")}


def test_shards_of_rows_that_all_agree(spark):
    df = spark.createDataFrame([(1, "t")] * 40, "doc_id long, text string")
    got = sharding.shard_digest(df).collect()
    assert [sum(r["shard"] == s for r in got) for s in range(8)] == [5] * 8


def test_shards_of_hot_equal_rows_follow_running_bytes(spark):
    """A third of all rows are copies without an id: against a plain walk in key order."""
    rows = [(None, "hot text " * 6)] * 4000 + [(k, f"text {k} " + "y" * (k % 90)) for k in range(8000)]
    rows += [(5, "text 5 again")] * 30 + [(None, None)] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((hashlib.md5("".join(r[1] or "").encode()).hexdigest(), -1 if r[0] is None else r[0], len(r[1] or "") + 1) for r in rows)
    total, at, want = sum(r[2] for r in got), 0, collections.Counter()
    for _, i, size in got:
        want[i, size, min(7, (2 * at + size) * 8 // (2 * total))] += 1
        at += size
    made = sharding.shard_digest(df).collect()
    assert collections.Counter((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["shard"]) for r in made) == want
    for s in range(8):
        mine = sorted(r["slot"] for r in made if r["shard"] == s)
        assert mine == list(range(len(mine)))


def test_hot_equal_rows_have_a_range_of_their_own(spark):
    rows = [("a", 1, 10)] * 1 + [(f"k{k:04}", k, 10) for k in range(2000)]
    keys = spark.createDataFrame([(k, t, s, s * (1000 if k == "k0700" else 1), 1000 if k == "k0700" else 1) for k, t, s in rows],
                                 "__key string, __tie long, __size long, __bytes long, __rows long")
    bounds, held, hot = sharding.splitters_for(keys, 64)
    assert [held[k] for k in hot] == [(10_000, 1000)]


@pytest.mark.parametrize("most", [1000, 0])  # groups are broadcast, or meet in a salted join
def test_mix_of_rows_that_agree(spark, most):
    rows = [(None, "w " * 10, "a")] * 4000 + [(k, "w " * 10, "b") for k in range(1000)] + [(7, "w w", None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    took = mixing.copies(df, max_broadcast=most).groupBy("source").agg(
        F.sum(F.col("__size") * F.col("__copies")).alias("n"), F.first("__target").alias("t"), F.count("*").alias("rows"),
        F.max("__copies").alias("most"), F.min("__copies").alias("least")).collect()
    assert {r["source"]: r["rows"] for r in took} == {"a": 4000, "b": 1000, None: 3}
    for r in took:
        assert r["most"] - r["least"] <= 1 and r["most"] <= 2
        if r["source"] == "a":
            assert abs(r["n"] - r["t"]) <= 10
    assert mixing.mix_digest(df).count() == 5003


def test_quality_numbers_do_not_depend_on_slices():
    text = "The quick fox, the lazy dog.\n\n  And 12 more!\n" * 40 + "x" * 90 + " end\n" + "The quick fox, the lazy dog.\n" * 9
    whole = quality.features(text)
    for size in (7, 16, 50, 333):
        assert np.allclose(quality.features(text, size), whole, rtol=0, atol=1e-12)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    at = len(quality.CLASSES)
    assert whole[at + 3] == len(set(words)) / len(words) and whole[at + 4] == len(set(lines)) / len(lines)


def test_targets_fill_like_connected_vessels():
    got = mixing.targets([10, 100, 1000], [5.0, 2.0, 1.0], 1665.0, 2.0)
    assert got == [20.0, 200.0, 1445.0]
    assert mixing.targets([0, 0], [5.0, 2.0], 0.0, 2.0) == [0.0, 0.0]


def test_mix_repeats_rows(edge):
    from pyspark.sql import functions as F

    copies: dict = collections.Counter()
    for r in mixing.copies(edge).select(*edge.columns[:4], "__copies").collect():
        copies[tuple(r[:4])] += r["__copies"]
    out = mixing.mix(edge)
    assert out.columns == edge.columns
    given = edge.groupBy(*edge.columns[:4]).agg(F.count("*").alias("n")).collect()
    took = {tuple(r[:4]): r["n"] for r in out.groupBy(*edge.columns[:4]).agg(F.count("*").alias("n")).collect()}
    for r in given:
        assert took.get(tuple(r[:4]), 0) == copies[tuple(r[:4])]
