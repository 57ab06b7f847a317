"""Importance resampling against a plain program; head and tail give the same."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pricewright.llm import resample
from pricewright.llm.common import table

from .conftest import edge_rows

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain(docs, target):
    """(doc_id, n_features, weight, score, rank) of rows (doc_id, text)."""
    found = [features(t) for _, t in docs]
    s, t = Counter(b for _, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for (i, _), (n, f) in zip(docs, found):
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    order = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    out = [(*r[:4], k + 1 if k < 5 * len(order) // 100 else None) for k, r in enumerate(order)]
    return sorted(out + [(*r[:4], None) for r in rows if r[4] < 20], key=repr)


def check(spark, docs, target, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame([(x,) for x in target], "text string")
    got = resample.resample(d, t, **kw).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=repr) == plain(docs, target)


def test_edge_rows(spark, bench_items):
    docs = [r[:2] for r in edge_rows()]
    check(spark, docs, [r["text"] for r in bench_items.collect()])


def test_a_third_are_equal_rows(spark):
    rng = np.random.default_rng(5)
    docs = [(k, " ".join(f"w{x}" for x in rng.integers(0, 60, int(rng.integers(1, 80))))) for k in range(200)]
    docs += [(None, " ".join(["same"] * 25))] * 100 + [(7, docs[7][1])] * 3
    check(spark, docs, ["w1 w2 w3", "w4", None, ""])


@pytest.mark.parametrize("size", [0, 1, 5])
def test_head_size_changes_no_number(spark, size):
    docs = [(k, f"alpha beta gamma délta {k} alpha beta " * (k % 7 + 3)) for k in range(60)]
    check(spark, docs, ["alpha beta gamma"], head_size=size)


def test_crc_by_states_and_slices(monkeypatch):
    monkeypatch.setattr(resample, "SLICE", 50)
    monkeypatch.setattr(resample, "CHUNK", 30)
    rng = np.random.default_rng(1)
    words = ["a", "bb", "é", "longer" * 5, "x" * 61, "y" * 62, "z" * 63, "東京", "0"]
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 2, 3, 50, 400)] + [None, "", " . ", "A B", "bb\u00a0bb é"]
    vocabulary = [w.encode() for w in words[:7]]
    pairs = [a + b" " + b for a in vocabulary for b in vocabulary]
    for head in (resample.Head([], []), resample.Head(vocabulary, []), resample.Head(vocabulary, pairs)):
        got = [Counter() for _ in texts]
        for ws, owner, before in resample.chunks(texts):
            for last, bucket in resample.Buckets(head).of(ws, before):
                for k, b in zip(owner[last], bucket):
                    if k >= 0:
                        got[k][int(b)] += 1
        assert got == [Counter(features(t)[1]) for t in texts]


def test_pruning_keeps_the_frequent():
    c = Counter({k: 1 for k in range(resample.HELD)})
    c.update({"often": 99})
    kept = resample._pruned(c)
    assert kept["often"] == 99 and 2 * len(kept) <= resample.HELD


def test_empty_tables_and_clashing_names(spark, empty, edge, clashing, bench_items):
    assert resample.resample_digest(empty, bench_items).count() == 0
    assert resample.resample_digest(edge, bench_items.limit(0)).count() == len(edge_rows())
    from pyspark.sql import functions as F
    own = clashing.withColumns({"row": F.lit("r"), "id": F.lit("i"), "rank0": F.lit("k"), "eligible": F.lit("e"), "noise": F.lit("n")})
    out = resample.resample(own, bench_items)
    kept = [c for c in own.columns if c not in ("score",)]
    assert sorted(map(repr, out.select(*kept).collect())) == sorted(map(repr, own.select(*kept).collect()))
    assert out.columns == [*kept, "n_features", "weight", "score", "rank"]


def test_same_for_any_partitions(spark):
    docs, target = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "benchmark")
    one, many = (sorted(map(tuple, resample.resample_digest(docs.repartition(n), target).collect()), key=repr) for n in (1, 13))
    assert one == many
