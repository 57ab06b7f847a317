"""Terms as numbers, against counting a document's strings."""

from collections import Counter

import pandas as pd
import pytest

from pricewright.functions import counting

WIDE = "".join(map(chr, [*range(0x4E00, 0x9000), *range(0x20000, 0x2F000)]))  # more characters than 16 bits number
TEXTS = ["", None, "a b", " aa\tbb_1  the of Été ", "naïve ﬁne İstanbul", "😀x 😀😀 y", "the the of", "a", "9.99 x-ray 𝔘nicode", WIDE,
         "aa bb aa bb cc " * 30]
ANALYZERS = [("char_wb", 2, 4, None, True), ("char_wb", 3, 4, None, False), ("char_wb", 1, 3, None, True), ("char_wb", 3, 5, None, True),
             ("word", 1, 1, None, True), ("word", 1, 2, ("the", "of"), False), ("word", 1, 3, ("the",), True)]


class Docs:
    """A task's batches."""

    def select(self, *cols):
        return self

    def mapInPandas(self, run, schema):
        return list(run(iter([pd.DataFrame({"t": TEXTS[:5]}), pd.DataFrame({"t": TEXTS[5:]})])))


@pytest.mark.parametrize("args", ANALYZERS, ids=str)
@pytest.mark.parametrize("held", [1, 20, 1 << 19])
def test_counts_of_numbered_terms(args, held):
    df, tc = Counter(), Counter()
    for t in TEXTS:
        for term, n in counting.make_counter(*args)(t).items():
            df[term] += 1
            tc[term] += n
    got = pd.concat(counting.count_corpus(Docs(), "t", {"b": args}, held)).groupby("term")[["df", "tc"]].sum()
    assert {k: (r.df, r.tc) for k, r in zip(got.index, got.itertuples())} == {k: (df[k], tc[k]) for k in df}


@pytest.mark.parametrize("args", ANALYZERS, ids=str)
def test_known_numbered_terms(args):
    every = sorted({term for t in TEXTS[:9] + TEXTS[10:] for term in counting.make_counter(*args)(t)})
    number = {term: 7 * i + 1 for i, term in enumerate(every) if i % 3}
    index = counting.known_indexer(number, *args)
    for t in TEXTS:
        idx, tf = index(t)
        want = {number[w]: n for w, n in counting.make_counter(*args)(t).items() if w in number}
        assert dict(zip(idx.tolist(), tf.tolist())) == want and len(idx) == len(want)


def test_a_task_without_texts_and_an_empty_vocabulary():
    class Empty(Docs):
        def mapInPandas(self, run, schema):
            return list(run(iter([])))

    for args in ANALYZERS:
        assert not sum(map(len, counting.count_corpus(Empty(), "t", {"b": args})))
        assert [len(x) for x in counting.known_indexer({}, *args)("aa bb cc")] == [0, 0]


@pytest.mark.parametrize("cap", [1, 3, 5, 8, 12, 40, 10_000])
def test_pairs_of_rare_words_are_not_counted(spark, cap, monkeypatch):
    """The vocabulary is that of counting every pair; pairs of words too rare for it
    never leave a task."""
    import random

    from pyspark.sql import functions as F

    from pricewright.operators import tfidf as T

    rnd = random.Random(cap)
    often, rare = [f"w{i}" for i in range(12)], [f"rare{i}" for i in range(400)]
    rows = [(str(i), " ".join(rnd.choices(often, [2.0 ** -k for k in range(12)], k=12) + ["the"] + rnd.sample(rare, 3))) for i in range(80)]
    docs = spark.createDataFrame(rows, "sample_id string, t string")
    p = T.TfidfParams(T.Analyzer("word", 1, 2, stop_words=True), min_df=2, max_df=0.8, max_features=cap, prefix="w:")
    chars = T.TfidfParams(T.Analyzer("char_wb", 2, 3), min_df=2, max_features=30, prefix="c:")
    sent = []
    once = T.count_corpus
    monkeypatch.setattr(T, "count_corpus", lambda *a, **k: sent.append(once(*a, **k)) or sent[-1])
    got = T.fit_blocks(docs, [], "t", [p, chars]).vocab.drop("idx").orderBy("term").collect()
    moved = sum(d.filter(F.contains("term", F.lit(" ")) & (F.col("block") == "w:")).agg(F.sum("tc")).first()[0] or 0 for d in sent)
    monkeypatch.undo()
    want = []
    for q in (p, chars):
        want += T.fit_vocabulary(T.corpus_stats(docs, "t", q.analyzer), T.n_docs_of(docs), q).collect()
    assert got == sorted(want, key=lambda r: r["term"])
    every = T.corpus_stats(docs, "t", p.analyzer).filter(F.contains("term", F.lit(" "))).agg(F.sum("tc")).first()[0]
    assert moved < every
