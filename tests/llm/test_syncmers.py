"""Fingerprints against a plain walk over the sorted documents."""

import hashlib
import random

import pytest
from conftest import SF_SMALL

from pricewright.llm import syncmers as X


def expected(rows):
    """rows (doc_id, text): the order is descending id, null last, ties by digest."""
    def place(r):
        i, t = r
        return (i is None, -(i or 0), hashlib.md5(t.encode()).hexdigest())

    rows = sorted([(i, t or "") for i, t in rows], key=place)
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        h = len(t) // 2
        e = t[:len(t) - h] + following[:h]
        a, b, c = X.sketch(t), X.sketch(e), X.sketch(following)
        in_e, in_next = (X.passages(X.placed(t), X.placed(x), len(t)) for x in (e, following))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), X.shown(a), X.shown(b), X.likeness(a, b), X.likeness(a, c),
                    X.covered(in_e), X.covered(in_next), max((int(n) for _, _, n in in_next), default=0)))
    return sorted(out, key=repr)


def plain_anchors(text):
    """{position: k-mer} by the definition, a k-mer at a time."""
    def order(s):
        return int(X.mix64(X._polynomial(X.mix64(X.code_points(s).astype("u8") + X.np.uint64(1)), X.S))[0])

    out = {}
    for p in range(len(text) - X.K + 1):
        inner = [order(text[p + j:p + j + X.S]) for j in range(X.K - X.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out[p] = text[p:p + X.K]
    return out or ({0: text} if text else {})


def test_edges(edge):
    got = sorted(map(tuple, X.fingerprint_digest(edge).collect()), key=repr)
    assert got == expected([(r["doc_id"], r["text"]) for r in edge.collect()])


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted(map(tuple, X.fingerprint_digest(docs).collect()), key=repr)
    assert got == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_one_document_is_its_own_next(spark):
    df = spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")
    (r,) = X.fingerprint_digest(df).collect()
    assert r["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and r["near_next"] == 1.0


@pytest.mark.parametrize("seed", range(3))
def test_blocks_do_not_change_anchors_and_contexts_do_not_matter(seed, monkeypatch):
    rng = random.Random(seed)
    text = "".join(rng.choice("abcdefgh é😀") for _ in range(3000))
    whole = {(int(p), int(h)) for where, hashes in X.anchors(text) for p, h in zip(where, hashes)}
    monkeypatch.setattr(X, "BLOCK", 97)
    assert {(int(p), int(h)) for where, hashes in X.anchors(text) for p, h in zip(where, hashes)} == whole
    inside = {(p - 500, h) for p, h in whole if 500 <= p <= 1500 - X.K}
    alone = {(int(p), int(h)) for where, hashes in X.anchors(text[500:1500]) for p, h in zip(where, hashes)}
    assert inside == alone


def test_closed_syncmers_by_definition():
    """A k-mer is chosen exactly when a least inner hash lies at an edge, so of
    any K - S + 1 neighbouring k-mers at least one is chosen."""
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(2000))
    at = sorted(int(p) for where, _ in X.anchors(text) for p in where)
    assert at == sorted(plain_anchors(text))
    gaps = [b - a for a, b in zip(at, at[1:])]
    assert max(gaps) <= X.K - X.S + 1


def test_likeness_follows_shared_text():
    rng = random.Random(2)
    a, b = ("".join(rng.choice("abcdefghijklmnop ") for _ in range(4000)) for _ in range(2))
    assert X.likeness(X.sketch(a), X.sketch(a)) == 1.0
    assert X.likeness(X.sketch(a), X.sketch(b)) < 0.05
    assert 0.2 < X.likeness(X.sketch(a), X.sketch(X.edited(a, b))) < 0.48  # a third of all anchors


@pytest.mark.parametrize("seed", range(4))
def test_passages_against_plain_matching(seed):
    """Every passage is equal in both texts, and a character lies in one exactly
    when a k-mer chosen by the definition covers it and stands in the other text."""
    rng = random.Random(seed)

    def new(n):
        return "".join(rng.choice("abcdé 😀") for _ in range(n))

    shared = [new(rng.randint(10, 120)) for _ in range(6)]
    a = "".join(x for s in shared for x in (new(rng.randint(0, 60)), s)) + shared[0]
    b = "".join(x for s in rng.sample(shared, 6) for x in (new(rng.randint(0, 60)), s))
    spans = X.passages(X.placed(a), X.placed(b), len(a))
    inside = set()
    for p, q, n in spans.tolist():
        assert a[p:p + n] == b[q:q + n] and n >= X.K
        inside |= set(range(p, p + n))
    there = set(plain_anchors(b).values())
    want = {x for p, k in plain_anchors(a).items() if k in there for x in range(p, p + X.K)}
    assert inside == want and X.covered(spans) == len(want)
    for s in shared:  # none of the shared passages is missed
        if len(s) >= 2 * X.K - X.S:
            assert inside & set(range(a.find(s), a.find(s) + len(s)))


def test_moved_passages_keep_their_places():
    rng = random.Random(9)
    one, two = ("".join(rng.choice("abcdefghijklmnop ") for _ in range(500)) for _ in range(2))
    a, b = X.placed(one + two), X.placed(two + one)
    spans = X.passages(a, b, 1000)
    moved = {int(q - p) for p, q, _ in spans}
    assert moved == {500, -500} and X.covered(spans) > 960
    assert X.passages(a, X.placed(""), 1000).shape == (0, 3) and X.covered(X.passages(X.placed(""), a, 0)) == 0
    short = X.placed("abc")
    assert X.passages(short, short, 3).tolist() == [[0, 0, 3]]


def test_least_hashes_of_texts_that_repeat():
    few = X.np.repeat(X.mix64(X.np.arange(50, dtype="u8")), 400)
    many = X.np.concatenate([X.np.repeat(few, 3), X.mix64(X.np.arange(9000, dtype="u8"))])
    for h in (few, many, many[:0]):
        assert X.least(h).tolist() == sorted({int(x) >> (64 - 4 * X.HEX) for x in h})[:X.KEPT]
