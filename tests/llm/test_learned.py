"""Held-out accuracy of the learned operators."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricewright.llm import langid, quality, secret_scan, toxicity

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def test_language(docs):
    got = langid.langid_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.98


def test_language_backoff_of_unseen_words():
    model = langid.Model(["a", "b"], (["hello"], [[5, 0]]), (["^wor", "w"], [[0, 3], [3, 0]]),
                         {"words": {"a": 5}, "grams": {"a": 3, "b": 3}})
    assert langid.predict(langid.Rows(model), "hello")[0] == "a"
    assert langid.predict(langid.Rows(model), "world")[0] == "b"  # its 4-gram, not its letter
    assert langid.predict(langid.Rows(model), "two")[0] == "a"  # back to single letters
    assert langid.predict(langid.Rows(model), "zzz") == ("a", 0.5)  # nothing known: first by code point


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(), st.sampled_from("aé_ 1²½٣ǅİß-'\u00a0\u3000東"))))
def test_words_by_tables_are_the_pattern(text):
    assert langid.find_words(text.replace("\ud800", "")) == langid.WORD.findall(text.replace("\ud800", "").lower())


def test_memory_changes_no_score():
    """Whatever a task remembers, a word has the row that the plain rule gives."""
    rng = np.random.default_rng(0)
    known = sorted({"".join(rng.choice(list("abc"), 3)) for _ in range(12)})
    pieces = sorted({g for w in known for n in langid.GRAM_LENGTHS for g in langid.grams(w, n)})[::2]
    model = langid.Model(["x", "y", "z"], (known, rng.integers(0, 9, (len(known), 3))), (pieces, rng.integers(0, 9, (len(pieces), 3))),
                         {"words": {"x": 50, "y": 40, "z": 30}, "grams": {"x": 90, "y": 80, "z": 70}})

    def plain(word):
        if word in model.words:
            return model.table[model.words[word]]
        for n in langid.GRAM_LENGTHS:
            rows = [model.table[model.grams[g]].astype(float) for g in langid.grams(word, n) if g in model.grams]
            if rows:
                return sum(rows) / len(rows)
        return np.zeros(3)

    texts = [" ".join("".join(rng.choice(list("abcd"), rng.integers(1, 6))) for _ in range(rng.integers(1, 60))) for _ in range(80)]
    rows = langid.Rows(model, held=20)
    for at in range(0, 80, 7):
        langs, scores = langid.predict_all(rows, texts[at:at + 7])
        for text, lang, score in zip(texts[at:at + 7], langs, scores):
            sums = sum(plain(w) for w in text.split())
            p = np.exp(sums - sums.max())
            assert lang == model.langs[int(sums.argmax())] and abs(score - p.max() / p.sum()) < 1e-4


def test_small_languages_keep_their_words(spark):
    """A language with a few documents beside one with many."""
    rng = np.random.default_rng(1)

    def text(first, n):
        return " ".join(first + "".join(rng.choice(list("bcdfgh"), 5)) for _ in range(n))

    rows = [(k, text("o", 200), "big") for k in range(300)] + [(1000 + k, text("u", 40), "small") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, max_words=400, max_grams=400)
    mine = [w for w in model.words if w.startswith("u")]
    assert len(mine) >= 150 and len(model.words) <= 440
    test = [text("o", 3) for _ in range(50)] + [text("u", 3) for _ in range(50)]
    got, _ = langid.predict_all(langid.Rows(model), test)
    assert np.mean([a == b for a, b in zip(got, ["big"] * 50 + ["small"] * 50)]) > 0.95


def test_quality(docs, labels):
    got = quality.quality_digest(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.93


def test_toxicity_on_more_rows(spark):
    d, l = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity_digest(d, l).join(l, "doc_id").filter("held_out").collect()
    y, p = np.array([r["toxic"] for r in got]), np.array([r["predicted"] for r in got])
    assert (p[y == 0] == 1).mean() < 0.01 and (p[y == 1] == 1).mean() > 0.8


def test_gradients_of_the_network():
    """Backpropagation against finite differences."""
    net = toxicity.Network(3, 3, seed=1)
    g = np.random.default_rng(0)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    table = np.concatenate([net.pad_gates(), g.standard_normal((6, 6 * toxicity.HIDDEN))])
    win = g.integers(0, 7, (3, toxicity.WINDOW)).astype(np.int32)
    win[:, 0] = 1
    d = np.array([0.3, -0.7, 0.2])
    loss = lambda: float((net.pooled(table[win.T], (win.T == 0).astype(float)).astype(float) * d).sum())
    grads, dgx, _ = net.gradients(table, win, lambda _: d)
    for name in ("Uf", "Ub", "A", "v", "o"):
        w = net.p[name]
        at = np.unravel_index(np.argmax(np.abs(grads[name])), w.shape)
        eps = 1e-2
        w[at] += eps
        up = loss()
        w[at] -= 2 * eps
        down = loss()
        w[at] += eps
        assert abs((up - down) / (2 * eps) - grads[name][at]) < 0.05 * abs(grads[name][at]) + 1e-3, name


def test_windows_overlap_and_cover():
    for n in (0, 1, 16, 17, 32, 33, 48, 49, 100):
        idx = np.arange(1, n + 1, dtype=np.int32)
        w = toxicity.windows(idx)
        assert set(w.reshape(-1)) - {0} == set(idx)
        assert w.shape[1] == toxicity.WINDOW and (len(w) == 1 or (w[:-1, toxicity.STRIDE:] == w[1:, :toxicity.STRIDE]).all())


def test_slices_of_long_texts_score_like_the_whole(monkeypatch):
    m = toxicity.train(["you idiot scum", "a fine day", "idiot you", "nice day fine"] * 4, [1, 0, 1, 0] * 4, steps=20)
    text = " ".join(["fine day nice a"] * 40 + ["idiot scum"] + ["a day"] * 40)
    whole = toxicity.summaries(m.net, toxicity.Words(m.net), [text])[0]
    parts = toxicity.slices
    monkeypatch.setattr(toxicity, "slices", lambda t: parts(t, 100))
    cut = toxicity.summaries(m.net, toxicity.Words(m.net), [text])[0]
    assert abs(cut.top[0] - whole.top[0]) < 0.5


def test_secrets(docs):
    found = secret_scan.secret_digest(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in found:
        word = texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        planted = len(word) == 40 and set(word.lower()) <= set("0123456789abcdef")
        assert r["is_secret"] == planted, word


def test_secrets_with_labelled_findings(spark):
    token = "a1b2c3d4e5f6a7b8c9d0"
    rows = [(k, f"api key = \"{token}{k:02d}\" end" if k % 2 else f"commit {token}{k:02d} merged", f"repo/{k % 3}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(k, 11 if k % 2 else 7, k % 2 == 1) for k in range(0, 60)], "doc_id long, start long, is_secret boolean")
    got = secret_scan.scan(docs, secret_scan.fit(docs, labels.filter("doc_id < 40"))).collect()
    assert all(r["is_secret"] == (r["doc_id"] % 2 == 1) for r in got) and len(got) == 60


@pytest.mark.parametrize("size", [1, 7, 100, 333, 1000])
def test_toxicity_windows_do_not_depend_on_slices(size, monkeypatch):
    rng = np.random.default_rng(size)
    monkeypatch.setattr(toxicity, "HELD", 40)
    monkeypatch.setattr(toxicity, "TAKEN", 60)
    net = toxicity.Network(seed=3)
    net.word, net.part = (rng.standard_normal((2, toxicity.DIM)).astype(np.float32) for _ in range(2))
    net.word_row[:], net.part_row[:] = rng.integers(0, 2, toxicity.ROWS), rng.integers(0, 2, toxicity.ROWS)
    pieces = ["stone ", "River, ", "é ", "12 ", "\n\n", "x" * 40, "longerword", "- "]
    texts = ["".join(rng.choice(pieces, n)) for n in (0, 3, 16, 31, 32, 33, 48, 49, 900)] + ["y" * 3000, "word " * 32, "word " * 48]
    for text in texts:
        assert [w for part in toxicity.words_of(text, size) for w in part] == toxicity.WORD.findall(text.lower())
    whole = toxicity.summaries(net, toxicity.Words(net), texts)
    for a, b, text in zip(whole, toxicity.summaries(net, toxicity.Words(net), texts, size), texts):
        words = len(toxicity.WORD.findall(text.lower()))
        assert a.n == b.n == max(1, -(-(words - 16) // 16))
        assert np.allclose(a.features(), b.features(), atol=1e-4)


def test_secrets_are_learned_from_all_texts(spark):
    """Words of every text count, whatever their number or length."""
    rows = [(k, f"alpha{'bcdefghij'[k % 9]} beta", None, "s", 9) for k in range(4500)] + [(4500, "zulu " * 30_000, None, "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lang, _ = secret_scan.fit(docs)
    assert "zulu" in lang.words
    words = [w for r in rows for w in secret_scan.WORD.findall(r[1])]
    pairs = [a + b for w in words for a, b in zip(f"^{w}", f"{w}$")]
    assert lang.bigrams["zu"] == pytest.approx(np.log(30_000 / len(pairs)))
