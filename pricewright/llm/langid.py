"""Language identification by word-first backoff.

A word is a run of letters.  A known word scores by its log frequency in each
language.  An unseen word falls back to its character 5-grams (with word
edges), then 4-, 3-, 2- and 1-grams: the mean log frequency of the known grams
of the first length that has any.  A document's score is the softmax of its
sums.

The model is fitted on a bounded sample of labelled documents: about
``docs_per_lang`` of each language, chosen by a hash of the id.  It keeps up to
``max_words`` words and ``max_grams`` grams, and every language has an equal
share of both, filled with its own most frequent ones, so that languages with
few documents keep theirs.  With so many languages that the table would hold
more than ``max_cells`` numbers, the shares shrink.  All bounds are parameters;
scoring reads every word of every text.  A task looks up the words of a batch
together and backs off once for each distinct unseen word; it remembers up to
``HELD`` of those, and then lets go of the older half.

Edge cases: null text, or text without a letter: ``und`` with score 0.  Equal
sums go to the first language by code point.  Without any labelled document, or
with an empty table, everything is ``und``.  Rows without an id are neither
learned from nor held out in the query.  Repeated rows count as often as they
occur in the sample.  Very long texts are counted slice by slice.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, slices, small_batches, text_key, uniform

WORD = re.compile(r"[^\W\d_]+")
GRAM_LENGTHS = (5, 4, 3, 2, 1)
#: Distinct counts or words that a task holds before it lets go of them.
HELD = 100_000
#: Words, times languages, that are looked up together.
LOOKED_UP = 1 << 18
ASCII = bytes(b if chr(b).isalpha() else 32 for b in range(128)) + bytes(range(128, 256))
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether a code point belongs to a word, for all code points."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalnum() and not chr(c).isdecimal() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def find_words(part: str) -> list[str]:
    """``WORD.findall(part.lower())``, by tables."""
    low = part.lower()
    if low.isascii():
        return low.encode().translate(ASCII).decode().split()
    codes = np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32)
    return np.where(letters()[codes], codes, np.uint32(32)).tobytes().decode("utf-32-le").split()


def word_counts(text: str) -> Counter:
    out: Counter = Counter()
    for part in slices(text):
        out.update(find_words(part))
    return out


def has_letter(words) -> bool:
    return any(any(map(str.isalpha, w)) for w in words)


def grams(word: str, n: int) -> list[str]:
    edged = f"^{word}$" if n > 1 else word
    return [edged[k:k + n] for k in range(len(edged) - n + 1)]


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter = Counter()

    def flush() -> pd.DataFrame:
        out = pd.DataFrame([(lang, w, n) for (lang, w), n in held.items()], columns=["lang", "item", "n"])
        held.clear()
        return out

    for b in batches:
        for lang, text in zip(b["lang"], b["text"]):
            for w, n in word_counts(text).items():
                held[lang, w] += n
            if len(held) > HELD:
                yield flush()
    yield flush()


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter = Counter()

    def flush() -> pd.DataFrame:
        out = pd.DataFrame([(lang, g, n) for (lang, g), n in held.items()], columns=["lang", "item", "n"])
        held.clear()
        return out

    for b in batches:
        for lang, w, n in zip(b["lang"], b["item"], b["n"]):
            for length in GRAM_LENGTHS:
                for g in grams(w, length):
                    held[lang, g] += n
            if len(held) > HELD:
                yield flush()
    yield flush()


class Model:
    """Log frequencies: rows of ``table`` for words and grams, a column a language."""

    def __init__(self, langs: list[str], words: tuple[list[str], np.ndarray], gram_rows: tuple[list[str], np.ndarray],
                 totals: dict[str, dict[str, int]]):
        """``words`` and ``gram_rows``: the items, and their counts by language."""
        self.langs = langs
        self.words = {w: k for k, w in enumerate(words[0])}
        self.grams = {g: len(words[0]) + k for k, g in enumerate(gram_rows[0])}
        parts = []
        for (items, counts), name in ((words, "words"), (gram_rows, "grams")):
            total = np.array([totals[name].get(x, 0) for x in langs], float)
            counts = np.asarray(counts, float).reshape(len(items), len(langs))
            parts.append(np.log((counts + 0.5) / (total + 0.5 * max(1, len(items)))).astype(np.float32))
        self.table = np.concatenate(parts)

    def backed_off(self, words: list[str]) -> np.ndarray:
        """Rows of unseen words: the mean of their known grams of the first length
        that has any; zeros when not even a letter of a word is known."""
        get, found, lengths = self.grams.get, [], []
        for w in words:
            for n in GRAM_LENGTHS:
                known = [k for k in map(get, grams(w, n)) if k is not None]
                if known:
                    break
            found += known
            lengths.append(len(known))
        out = np.zeros((len(words), len(self.langs)), np.float32)
        size = np.array(lengths, np.int64)
        has = size > 0
        if has.any():
            starts = np.concatenate([[0], np.cumsum(size[has])[:-1]])
            out[has] = np.add.reduceat(self.table[found].astype(float), starts, axis=0) / size[has][:, None]
        return out


class Rows:
    """Rows of words, in a task: the model's own, and a bounded memory of words
    that were backed off, in two halves.  When both are full the older one goes."""

    def __init__(self, model: Model, held: int = HELD):
        self.model = model
        self.half = max(1, min(held, (1 << 24) // max(1, len(model.langs))) // 2)
        self.start = len(model.table)
        self.table = np.concatenate([model.table, np.zeros((2 * self.half, len(model.langs)), np.float32)])
        self.ids = dict(model.words)  # and the words in memory
        self.recent: list[list[str]] = [[], []]  # words of the older and the younger half
        self.young = 0  # which half of the memory is the younger one

    def of(self, words: list[str]) -> np.ndarray:
        """A row a word."""
        idx = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        out = self.table[idx]
        miss = np.flatnonzero(idx < 0)
        if len(miss):
            new: dict[str, int] = {}
            place = [new.setdefault(words[i], len(new)) for i in miss]
            fresh = self.model.backed_off(list(new))
            out[miss] = fresh[place]
            self._remember(list(new), fresh)
        return out

    def _remember(self, words: list[str], rows: np.ndarray) -> None:
        at = 0
        while at < len(words):
            mine = self.recent[1]
            if len(mine) == self.half:
                for w in self.recent[0]:
                    del self.ids[w]
                self.recent, self.young = [mine, []], 1 - self.young
                mine = self.recent[1]
            n = min(len(words) - at, self.half - len(mine))
            first = self.start + self.young * self.half + len(mine)
            self.table[first:first + n] = rows[at:at + n]
            self.ids.update(zip(words[at:at + n], range(first, first + n)))
            mine += words[at:at + n]
            at += n


def predict_all(rows: Rows, texts) -> tuple[list[str], np.ndarray]:
    """Language and score of each text, ``LOOKED_UP`` words at a time."""
    langs = rows.model.langs
    texts = list(texts)
    sums, lettered_ = np.zeros((len(texts), len(langs))), np.zeros(len(texts), bool)
    words: list[str] = []
    owner: list[int] = []
    sizes: list[int] = []

    def flush() -> None:
        if words and langs:
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            np.add.at(sums, owner, np.add.reduceat(rows.of(words), starts, axis=0, dtype=float))
        words.clear(), owner.clear(), sizes.clear()

    for k, text in enumerate(texts):
        for part in slices(text or ""):
            found = find_words(part)
            if found:
                lettered_[k] = lettered_[k] or has_letter(found)
                words.extend(found)
                owner.append(k)
                sizes.append(len(found))
                if len(words) * len(langs) >= LOOKED_UP:
                    flush()
    flush()
    if not langs:
        return ["und"] * len(texts), np.zeros(len(texts))
    best = sums.argmax(axis=1)  # the first of equals; languages are in order
    p = np.exp(sums - sums.max(axis=1, keepdims=True))
    score = np.round(1 / p.sum(axis=1), 9)
    return ([langs[b] if ok else "und" for b, ok in zip(best, lettered_)], np.where(lettered_, score, 0.0))


def predict(rows: Rows, text: str | None) -> tuple[str, float]:
    lang, score = predict_all(rows, [text])
    return lang[0], float(score[0])


def _kept(counts: DataFrame, langs: list[str], share: int) -> DataFrame:
    """Items that are among the ``share`` most frequent ones of a language, as
    rows (item, lang, n).  Counts are binned (16 bins a doubling), and a language
    takes its highest bins that hold at most so many, and a part of the next one,
    by a hash of the item.  Only bin sizes reach the driver."""
    level = F.floor(F.log2("n") * 16).cast("int")
    bins = counts.groupBy("lang", level.alias("level")).agg(F.count("*").alias("n")).collect()
    least = []
    for x in langs:
        held, at, over = 0, 1 << 30, None
        for r in sorted((r for r in bins if r["lang"] == x), key=lambda r: -r["level"]):
            if held + r["n"] > share:
                over = r
                break
            held, at = held + r["n"], r["level"]
        part = (share - held) / over["n"] if over else 0.0
        least.append((x, at, over["level"] if over else -1, part))
    bounds = counts.sparkSession.createDataFrame(least, "lang string, least int, partly int, part double")
    placed = counts.join(F.broadcast(bounds), "lang")  # a row a language
    taken = (level >= F.col("least")) | ((level == F.col("partly")) & (uniform("share", F.col("item")) < F.col("part")))
    items = placed.filter(taken).select("item").distinct()
    return counts.join(items, "item", "left_semi")


def fit(labelled: DataFrame, docs_per_lang: int = 4000, max_words: int = 100_000, max_grams: int = 100_000,
        max_langs: int = 1000, max_cells: int = 1 << 24) -> Model:
    """Learns from columns ``text`` and ``lang`` (and ``doc_id`` for the sample).
    More than ``max_langs`` languages are an error: a column of that kind holds
    something else."""
    small_batches(labelled.sparkSession)
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    found = rows.groupBy("lang").count().limit(max_langs + 1).collect()
    if len(found) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs = sorted(r["lang"] for r in found)
    if not langs:
        return Model([], ([], []), ([], []), {"words": {}, "grams": {}})
    share = rows.sparkSession.createDataFrame([(r["lang"], docs_per_lang / r["count"]) for r in found],
                                              "lang string, __share double")
    draw = uniform("lang", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text_key())
    sample = rows.join(F.broadcast(share), "lang").filter(draw < F.col("__share")).select("lang", "text")
    shape = "lang string, item string, n long"
    words = sample.mapInPandas(_count_words, shape).groupBy("lang", "item").agg(F.sum("n").alias("n")).persist()
    gram = words.mapInPandas(_count_grams, shape).groupBy("lang", "item").agg(F.sum("n").alias("n")).persist()
    number = {x: k for k, x in enumerate(langs)}

    def top(counts: DataFrame, most: int) -> tuple[list[str], np.ndarray]:
        most = min(most, max(1, max_cells // len(langs)))
        kept = _kept(counts, langs, max(1, most // len(langs))).toArrow()  # ``most`` items, ``max_cells`` rows at most
        items, at = np.unique(np.array(kept["item"].to_pylist(), object), return_inverse=True)
        out = np.zeros((len(items), len(langs)), np.float32)
        out[at, [number[x] for x in kept["lang"].to_pylist()]] = kept["n"].to_numpy()
        return items.tolist(), out

    def totals(counts: DataFrame) -> dict[str, int]:
        return {r["lang"]: r["t"] for r in counts.groupBy("lang").agg(F.sum("n").alias("t")).collect()}

    model = Model(langs, top(words, max_words), top(gram, max_grams), {"words": totals(words), "grams": totals(gram)})
    words.unpersist()
    gram.unpersist()
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``__lang`` and ``__score`` beside the columns of the documents."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_words and max_grams

    @F.pandas_udf("lang string, score double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rows = Rows(held.value)
        for t in texts:
            lang, score = predict_all(rows, t)
            yield pd.DataFrame({"lang": lang, "score": score})

    return docs.withColumn("__found", run(F.col("text").cast("string"))) \
               .withColumns({"__lang": F.col("__found.lang"), "__score": F.col("__found.score")}).drop("__found")


@F.pandas_udf(T.BooleanType())
def lettered(texts: pd.Series) -> pd.Series:
    """Whether a text has a letter, by the rule of ``predict``."""
    return pd.Series([any(has_letter(find_words(p)) for p in slices(x or "")) for x in texts], dtype=bool)


def langid_digest(docs: DataFrame) -> DataFrame:
    """One row a document: predicted language and score.  Learned from the
    documents outside the held-out fold."""
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.filter(fold(5) != 0))
    out = identify(rows.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"),
                      F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))
