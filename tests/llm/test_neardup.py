"""Near-duplicates against all pairs."""

import collections
import random
import re

import pytest
from conftest import SF_SMALL

from pricewright.llm import neardup as X

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = WORDS.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def expected(rows, n=2, percent=80):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for j, c in collections.Counter(j for g in s for j in holders[g]).items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                root[find(j)] = find(k)
        for g in s:
            holders[g].append(k)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted([(i, len(sets[k]), least.get(find(k)), i == least.get(find(k))) for k, (i, _) in enumerate(rows)], key=repr)


def near_copies(seed, n_groups=12, n_copies=25):
    """Groups of copies with ever more edits, chains of copies of copies, a
    passage that strangers share, and exact copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7)))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(n_groups):
        base = [word() for _ in range(rng.choice([30, 60, 150]))]
        last = base
        for k in range(n_copies):
            copy = list(rng.choice([base, last]))
            for _ in range(rng.randint(0, len(base) // 12)):
                copy[rng.randrange(len(copy))] = word()
            last = copy
            texts.append(copy)
    for _ in range(60):
        texts.append(passage + [word() for _ in range(rng.randint(0, 25))])
    texts += texts[:20]
    rng.shuffle(texts)
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


@pytest.mark.parametrize("seed", range(2))
def test_copies_of_copies(spark, seed):
    rows = near_copies(seed)
    got = X.duplicate_digest(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_repeated_rows(spark):
    """Near-copies in rows that agree in id and text, and in rows without id:
    repeats change no component."""
    rng = random.Random(0)
    rows = []
    for k, text in near_copies(0, n_groups=8):
        rows += [(None if rng.random() < 0.4 else k, text)] * rng.choice([1, 1, 2, 7])
    got = X.duplicate_digest(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_one_set_for_each_class(spark):
    """Rows that share an id and a text give one set row, so a pair is compared once."""
    base = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(base))] * 3 + [(None, " ".join([*base[:-1], "other"]))] * 5
    finder = X.Finder(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80)
    a, b = [r["node"] for r in finder.classes.orderBy(finder.classes["doc_id"].isNull()).collect()]
    n = 59
    pairs = spark.createDataFrame([(a, b, n, n)], "a long, b long, n_a long, n_b long")
    assert [len(r["rest"]) for r in finder.compared(pairs).collect()] == [1]


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, X.duplicate_digest(docs).collect()), key=repr) == expected(rows)


def test_edges(edge):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in X.duplicate_digest(edge).collect()}
    assert {(2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (-5, 8, -5, True), (1, 8, -5, False), (1, 5, 1, True),
            (None, 0, None, True), (None, 5, None, True)} <= got


def test_signature_guarantee():
    """Two signatures that differ in fewer than 2 * CHUNKS fields share a bucket."""
    import numpy as np
    import pandas as pd

    g = np.random.default_rng(3)
    for _ in range(30):
        a = g.integers(0, 1 << 16, X.FIELDS).astype("<u2")
        b = a.copy()
        where = g.choice(X.FIELDS, 2 * X.CHUNKS - 1, replace=False)
        b[where] ^= g.integers(1, 1 << 16, len(where)).astype("<u2")
        out = pd.concat(X._bucketed(iter([pd.DataFrame({"node": [1, 2], "sig": [a.tobytes(), b.tobytes()]})])))
        assert out.groupby("bucket")["node"].nunique().max() == 2


def test_one_of_each_keeps_the_columns(spark, clashing):
    kept = X.one_of_each(clashing, words=2)
    assert kept.columns == clashing.columns
    ids = sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] == 1)
    assert ids == [(1, "another text under the same id")]  # the other is a copy of -5
    assert kept.filter("doc_id = -5").count() == 1


@pytest.mark.parametrize("words", [1, 2, 5])
def test_slices_give_the_same_set(words, monkeypatch):
    text = " ".join(f"w{k % 37}x{k % 11}" for k in range(3000)) + " nbsp stays"
    whole = X.shingle_set(text, words, X.WordHashes())
    slices = X.word_slices
    monkeypatch.setattr(X, "word_slices", lambda t: slices(t, 50))
    assert X.shingle_set(text, words, X.WordHashes()).tolist() == whole.tolist()
    assert len(whole) == len(shingles(text, words))
