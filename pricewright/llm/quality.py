"""Quality by Bradley-Terry pairwise ranking.

A document is described by numbers over its whole text (character classes, word
and line lengths, repetition).  Preference pairs, each a good and a bad labelled
document, teach a linear score by the logistic loss on feature differences: the
probability that one document is preferred is the logistic function of the
difference of their scores.  The score at the quantile of the bad share, over
all labelled documents outside the held-out fold, is the threshold; it is mapped
to ``THRESHOLD`` on the scale from 0 to 1.

The weights are fitted on a bounded sample: ``max_each`` documents of each label,
each of at most ``max_chars`` characters, and ``pairs_each`` pairs for each bad
document.

Edge cases: null counts as empty, which has all its numbers 0; very long texts
are measured slice by slice, with the same numbers as in one piece; without
documents of both labels every score is the share of label 1 (0.5 without
labels); repeated rows have equal scores and count as often as they occur in the
threshold; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quantiles import exact_quantiles
from .common import filled, fold, slices
from .labelling import logistic, sample
from .syncmers import code_points

THRESHOLD = 0.3
CLASSES = ("upper", "lower", "letter", "digit", "space", "stop", "symbol", "punctuation", "other")


def _class(c: str) -> int:
    kind = unicodedata.category(c)
    if c.isspace():
        return 4
    if kind == "Lu":
        return 0
    if kind == "Ll":
        return 1
    if kind[0] in "LM":
        return 2
    if kind[0] == "N":
        return 3
    if c in ".,;:?'\"()":
        return 5
    if kind[0] == "S" or c in "%&#*@|!/\\_":
        return 6
    return 7 if kind[0] == "P" else 8


_class_of: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """Class of each code point below 2**16; made once in a process."""
    if not _class_of:
        _class_of.append(np.fromiter((_class(chr(c)) for c in range(1 << 16)), np.uint8, 1 << 16))
    return _class_of[0]


def lines_of(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end + 1


def features(text: str, size: int = 1 << 20) -> list[float]:
    counts = np.zeros(len(CLASSES))
    n_words = closed = capital = longest = changes = chars = n_lines = 0
    seen: set[int] = set()
    open_word, last = "", None
    for part in slices(text, size):
        c = code_points(part)
        kinds = class_table()[np.minimum(c, (1 << 16) - 1)]
        counts += np.bincount(kinds, minlength=len(CLASSES))
        changes += int((kinds[1:] != kinds[:-1]).sum()) + int(last is not None and kinds[0] != last)
        last = kinds[-1]
        chars += len(c)
        words = (open_word + part).split()
        # a word that the slice cuts goes on in the next one
        open_word = words.pop() if chars < len(text) and not part[-1].isspace() else ""
        n_words += len(words)
        seen.update(map(hash, words))
        closed += sum(not w[-1].isalnum() for w in words)
        capital += sum(w[0].isupper() for w in words)
        longest = max(longest, max(map(len, words), default=0))
    if not chars:
        return [0.0] * (len(CLASSES) + 9)
    seen_lines: set[int] = set()
    for line in lines_of(text):
        if line and not line.isspace():
            n_lines += 1
            seen_lines.add(hash(line))
    words_ = max(1, n_words)
    return [*(counts / chars), np.log1p(chars), np.log1p(n_words), (chars - counts[4]) / words_, len(seen) / words_,
            len(seen_lines) / max(1, n_lines), closed / words_, capital / words_, np.log1p(longest), changes / chars]


def described_texts(texts) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(len(texts), len(CLASSES) + 9)


class Model:
    """Linear score over standardised numbers and their squares."""

    def __init__(self, mean, spread, weights, cut: float, constant: float | None = None):
        self.mean, self.spread, self.weights, self.cut, self.constant = mean, spread, weights, cut, constant

    def described(self, f: np.ndarray) -> np.ndarray:
        z = np.clip((f - self.mean) / self.spread, -6, 6)
        return np.concatenate([z, z * z], axis=1)

    def raw(self, f: np.ndarray) -> np.ndarray:
        return self.described(f) @ self.weights

    def score(self, f: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(f), self.constant)
        x = self.raw(f) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(texts: list[str], y: list[int], totals: dict[int, int], pairs_each: int = 40, seed: int = 11) -> Model:
    y = np.array(y, int)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        n = sum(totals.values())
        return Model(None, None, None, 0.0, totals.get(1, 0) / n if n else 0.5)
    f = described_texts(texts)
    model = Model(f.mean(axis=0), f.std(axis=0) + 1e-6, None, 0.0)
    x = model.described(f)
    g = np.random.default_rng(seed)
    a, b = g.choice(good, len(bad) * pairs_each), np.repeat(bad, pairs_each)
    # each pair is shown in one of its two orders
    turned = g.random(len(a)) < 0.5
    d = np.where(turned[:, None], x[b] - x[a], x[a] - x[b])
    model.weights = logistic(d, (~turned).astype(float), ridge=1e-4, intercept=False)
    return model


def fit(docs: DataFrame, labels: DataFrame, max_each: int = 2500, max_chars: int = 200_000) -> Model:
    """Learns ``labels.quality`` outside the held-out fold: weights from the
    sample, the threshold from all of it."""
    rows, totals = sample(docs, labels, "quality", 0, 5, {1: max_each, 0: max_each}, max_chars)
    model = train([r["text"] for r in rows], [r["y"] for r in rows], totals)
    if model.constant is None:
        known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        known = known.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        learned = docs.filter(fold(5) != 0).select(F.col("doc_id").cast("long").alias("doc_id"),
                                                   _applied(docs, model, Model.raw).alias("raw"))
        share = totals[0] / (totals[0] + totals[1])
        model.cut = exact_quantiles(learned.join(known, "doc_id", "left_semi"), ["raw"], [share])[0][0]
    return model


def _applied(docs: DataFrame, model: Model, what) -> Column:
    """``what``, a method of the model, of each text."""
    held = docs.sparkSession.sparkContext.broadcast((model, what.__name__))  # some dozens of numbers

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, name = held.value
        for t in texts:
            yield pd.Series(getattr(m, name)(described_texts(t)), dtype="float64")

    return run(filled())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``__score`` beside the columns of the documents."""
    return docs.withColumn("__score", _applied(docs, model, Model.score))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a document: its quality."""
    rows = docs.select("doc_id", "text")
    value = F.round("__score", 9)
    return score(rows, fit(rows, labels)).select(
        "doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), value.alias("score"),
        (value >= THRESHOLD).cast("int").alias("predicted"))
