"""Token and n-gram rules: the JVM expressions, the per-document counter and a
direct re-statement of the documented rules agree."""

from collections import Counter

import pytest
import regex

from pricewright.functions import text as tx
from pricewright.functions import counting

DOCS = ["Hello  wörld, the café is OPEN 24h", "a", "", None, "ab cd\tef\ngh  ij", "The the THE and of x1 y22",
        "naïve résumé — coöperate", "one two three four five"]


def _analyze(t):
    src, dst = tx.accent_table()
    return (t or "").lower().translate(str.maketrans(src, dst))


def _char_wb(t, lo, hi):
    """Padded word; every n in range while it fits; a short word once."""
    out = []
    for w in t.split():
        w = f" {w} "
        for n in range(lo, hi + 1):
            if len(w) < n:
                if n == lo:
                    out.append(w)
                break
            out.extend(w[i:i + n] for i in range(len(w) - n + 1))
            if len(w) == n:
                break
    return Counter(out)


def _words(t, stop, n_max):
    toks = regex.findall(r"[\p{L}\p{N}_]{2,}", t)
    toks = [x for x in toks if x not in stop]
    out = list(toks)
    for n in range(2, n_max + 1):
        out += [" ".join(toks[i:i + n]) for i in range(len(toks) - n + 1)]
    return Counter(out)


@pytest.mark.parametrize("lo,hi", [(2, 4), (3, 4), (5, 6)])
def test_char_wb(spark, lo, hi):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(DOCS)], "i int, t string")
    jvm = df.select("i", tx.char_wb_ngrams(tx.analyzer_text("t"), lo, hi).alias("g")).collect()
    py = counting.count_terms(df, "i", "t", {"c": ("char_wb", lo, hi, None, True)}).collect()
    for i, t in enumerate(DOCS):
        want = _char_wb(_analyze(t), lo, hi)
        assert Counter(next(r["g"] for r in jvm if r["i"] == i)) == want
        assert {r["term"]: r["tf"] for r in py if r["i"] == i} == dict(want)


def test_word_ngrams(spark):
    stop = tx.spark_stop_words()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(DOCS)], "i int, t string")
    toks = tx.remove_stop_words(tx.word_tokens(tx.analyzer_text("t")))
    jvm = df.select("i", tx.word_ngrams(toks, 3).alias("g")).collect()
    py = counting.count_terms(df, "i", "t", {"w": ("word", 1, 3, stop, True)}).collect()
    for i, t in enumerate(DOCS):
        want = _words(_analyze(t), set(stop), 3)
        assert Counter(next(r["g"] for r in jvm if r["i"] == i)) == want
        assert {r["term"]: r["tf"] for r in py if r["i"] == i} == dict(want)


def test_slices_are_bounded_and_whole(spark, monkeypatch):
    """Rows leave in slices of a fixed size, whatever a text or a batch holds."""
    import pandas as pd

    monkeypatch.setattr(counting, "SLICE_ROWS", 7)
    seen = {}

    class Docs:
        schema = spark.createDataFrame([], "i int, t string").schema

        def select(self, *cols):
            return self

        def mapInPandas(self, run, shape):
            texts = [" ".join(f"w{j}" for j in range(k)) for k in (0, 3, 40, 1)]
            seen["parts"] = list(run(iter([pd.DataFrame({"i": range(4), "t": texts}), pd.DataFrame({"i": [9], "t": [None]})])))
            return shape

    counting.count_terms(Docs(), "i", "t", {"w": ("word", 1, 1, None, True), "c": ("char_wb", 2, 2, None, True)})
    assert all(len(p) <= 7 for p in seen["parts"]) and all(len(p) == 7 for p in seen["parts"][:-1])
    rows = pd.concat(seen["parts"])
    assert (rows[rows.block == "w"].groupby("i").size() == pd.Series({1: 3, 2: 40, 3: 1})).all()


def test_distinct_characters(spark):
    texts = ["", None, "aab", "é😀é", "a" * 5000, "ab" * 700 + "c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["r"] for r in df.select("i", tx.unique_char_ratio("t").alias("r")).collect()}
    assert got == {i: (len(set(t)) / len(t) if t else 0.0) for i, t in enumerate(texts)}


def test_corpus_counts_and_known_terms(spark):
    """Sums of a task and numbers of known terms, against counting a document at
    a time; a task that holds few terms sends them on more often."""
    from collections import Counter

    texts = ["", "aa aa b", "Ünï cödé aa", None, "the aa bbb of the b", "x" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(2)
    args = {"c:": ("char_wb", 2, 4, None, True), "w:": ("word", 1, 2, ("the", "of"), True)}
    for held in (1, 1 << 18):
        got = counting.count_corpus(docs, "t", args, held).groupBy("block", "term").agg({"df": "sum", "tc": "sum"}).collect()
        df, tc = Counter(), Counter()
        for b, a in args.items():
            for t in texts:
                for term, n in counting.make_counter(*a)(t).items():
                    df[b, term] += 1
                    tc[b, term] += n
        assert {(r["block"], r["term"]): (r["sum(df)"], r["sum(tc)"]) for r in got} == {k: (df[k], tc[k]) for k in df}
    number = {t: i for i, t in enumerate(sorted(b + t for b, t in df if t != "aa"))}
    rows = {r["i"]: dict(zip(r["idx"], r["tf"])) for r in counting.count_known(docs, "i", "t", list(args.items()), number).collect()}
    for i, t in enumerate(texts):
        assert rows[i] == {number[b + w]: n for b, a in args.items() for w, n in counting.make_counter(*a)(t).items() if b + w in number}


def test_ladders_share_one_reading_of_the_texts(spark, monkeypatch):
    """Settings with the same analyzer have one set of statistics, made in one pass,
    and rungs see the terms that they would see alone."""
    from dataclasses import replace

    from pricewright.operators import tfidf as T

    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(DOCS * 3)], "sample_id string, t string")
    words = T.TfidfParams(T.Analyzer("word", 1, 2), min_df=3, max_df=0.9, max_features=50)
    chars = T.TfidfParams(T.Analyzer("char_wb", 2, 3), min_df=0.5, max_features=20)
    ladder = [replace(words, min_df=1000), words, replace(words, max_features=4), chars, replace(chars, max_df=1.5)]
    want = [0 if T.invalid(p) else T.fit_vocabulary(T.corpus_stats(docs, "t", p.analyzer), T.n_docs_of(docs), p).count() for p in ladder]
    passes = []
    once = T.stats_by_block
    monkeypatch.setattr(T, "stats_by_block", lambda *a: passes.append(a) or once(*a))
    stats = T.kept_stats(docs, "t", ladder)
    assert [r.n_terms for r in T.climb(docs, "t", ladder, stats=stats)] == want
    assert [r.n_terms for r in T.climb(docs, "t", ladder[:2], stats=stats)] == want[:2]
    assert [r.chosen for r in T.climb(docs, "t", ladder, stats=stats)] == [False, True, False, False, False]
    assert len(passes) == 1 and want[1] > 4
