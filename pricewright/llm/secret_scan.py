"""Secret scan: a random forest that removes false positives.

Candidates are runs of at least ``MIN_LENGTH`` key characters.  Each is described
by its length and character classes, its character transitions (how often the
class changes, and how likely its bigrams are in the words of all texts), its
dictionary coverage (the share that common words of all texts make up), its
path (hashed parts of the source) and its neighbouring words (hashed, and
whether they name a credential or assign it).  The forest is trained from
labelled findings, and its probability decides.

Findings are labelled by a table (doc_id, start, is_secret) or, without one, by
``weak_label``, which is sure of few candidates and leaves the others to the
forest.  Fitting reads every text: words and bigrams are counted in the tasks
and added up by Spark, and the forest learns from all labelled findings.

Edge cases: null or empty texts have no candidates; repeated rows repeat their
findings; a null path is the empty path; very long texts are scanned slice by
slice; when the labels have one kind only, every candidate gets that label.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, filled, slices

MIN_LENGTH = 16
KEY_CHARS = r"A-Za-z0-9_+/=.@\-"
CANDIDATE = re.compile(rf"(?<![{KEY_CHARS}])[{KEY_CHARS}]{{{MIN_LENGTH},}}")
WORD = re.compile(r"[^\W\d_]+")
NAMES = re.compile(r"(?i)(?:key|token|secret|passw(?:or)?d|pwd|auth|bearer|credential)\W{0,3}$")
ASSIGNS = re.compile(r"[=:]\s*[\"']?$")
CONTEXT = 48
PATH_ROWS, WORD_ROWS = 4, 8
DICTIONARY = 5000
BIGRAMS = 100_000
HELD = 1 << 18


@dataclass
class Language:
    """Bigram log frequencies and common words."""

    bigrams: dict[str, float] = field(default_factory=dict)
    rare: float = -12.0
    words: frozenset = frozenset()

    @staticmethod
    def of(rows: DataFrame) -> Language:
        """From the ``text`` of all rows.  Kept on the driver: ``DICTIONARY`` words
        and the ``BIGRAMS`` most frequent pairs, of which alphabets have fewer;
        pairs beyond them count as rare."""
        counts = rows.select("text").mapInPandas(_counted, "kind string, item string, n long")
        counts = counts.groupBy("kind", "item").agg(F.sum("n").alias("n"))
        counts = cut_lineage(counts.filter((F.col("kind") == "pair") | (F.char_length("item") >= 3)))
        words = counts.filter("kind = 'word'").orderBy(F.desc("n"), "item").limit(DICTIONARY).collect()
        pairs = counts.filter("kind = 'pair'")
        total = pairs.agg(F.sum("n")).first()[0] or 1
        kept = pairs.orderBy(F.desc("n"), "item").limit(BIGRAMS).collect()
        return Language({r["item"]: math.log(r["n"] / total) for r in kept}, math.log(0.5 / total), frozenset(r["item"] for r in words))

    def likelihood(self, text: str) -> float:
        low = text.lower()
        got = [self.bigrams.get(a + b, self.rare) for a, b in zip(low, low[1:])]
        return sum(got) / len(got) if got else self.rare

    def coverage(self, text: str) -> float:
        """Share of the text that longest common words make up, left to right."""
        low, at, hit = text.lower(), 0, 0
        while at < len(low):
            n = next((n for n in range(min(12, len(low) - at), 2, -1) if low[at:at + n] in self.words), 0)
            hit += n
            at += n or 1
        return hit / len(text) if text else 0.0


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words and bigrams of a task's texts with their counts, sent on whenever
    ``HELD`` words are held."""
    words: Counter = Counter()

    def flush() -> Iterator[pd.DataFrame]:
        pairs: Counter = Counter()
        for w, n in words.items():
            for a, b in zip(f"^{w}", f"{w}$"):
                pairs[a + b] += n
        for kind, found in (("word", words), ("pair", pairs)):
            items = list(found.items())
            for at in range(0, len(items), 1 << 16):
                part = items[at:at + (1 << 16)]
                yield pd.DataFrame({"kind": pd.Series([kind] * len(part), dtype=object),
                                    "item": pd.Series([w for w, _ in part], dtype=object), "n": [n for _, n in part]})
        words.clear()

    for b in batches:
        for t in b["text"]:
            for part in slices(t):
                words.update(WORD.findall(part.lower()))
                if len(words) >= HELD:
                    yield from flush()
    yield from flush()


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def entropy(text: str) -> float:
    n = len(text)
    return -sum(k / n * math.log2(k / n) for k in Counter(text).values())


def candidates(text: str) -> Iterator[tuple[int, str, str, str]]:
    """(start, candidate, text before, text after)."""
    offset, held = 0, ""
    for part in slices(text):
        body = held + part
        for m in CANDIDATE.finditer(body, len(held)):
            word = m.group().rstrip(".-")
            if len(word) >= MIN_LENGTH:
                yield (offset - len(held) + m.start(), word, body[max(0, m.start() - CONTEXT):m.start()],
                       body[m.start() + len(word):m.start() + len(word) + CONTEXT])
        offset += len(part)
        held = part[-CONTEXT:]


def features(word: str, before: str, after: str, path: str, lang: Language) -> list[float]:
    n, kinds = len(word), [_kind(c) for c in word]
    share = [kinds.count(k) / n for k in range(4)]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:])) / (n - 1)
    hexed = sum(c in "0123456789abcdefABCDEF" for c in word) / n
    near = (WORD.findall(before.lower()) or [""])[-1], (WORD.findall(after.lower()) or [""])[0]
    places = [0.0] * (PATH_ROWS + 2 * WORD_ROWS)
    for part in re.split(r"[/\\.]", path):
        places[zlib.crc32(part.encode("utf-8")) % PATH_ROWS] = 1.0
    for k, w in enumerate(near):
        places[PATH_ROWS + k * WORD_ROWS + zlib.crc32(w.encode("utf-8")) % WORD_ROWS] = 1.0
    return [float(n), *share, hexed, entropy(word), changes, lang.likelihood(word), lang.coverage(word),
            len(set(word)) / n, float("@" in word), float("." in word), float(bool(NAMES.search(before.rstrip(" \"'=:")))),
            float(bool(ASSIGNS.search(before))), float(before[-1:] in "\"'" and before[-1:] == after[:1]), *places]


def weak_label(word: str, before: str, lang: Language) -> int | None:
    """1 and 0 where form and place leave no doubt; None elsewhere."""
    digits = sum(c.isdigit() for c in word) / len(word)
    named = bool(NAMES.search(before.rstrip(" \"'=:"))) and bool(ASSIGNS.search(before))
    if named and len(word) >= 20 and 0.1 < digits < 1 and entropy(word) >= 3:
        return 1
    if "@" in word or digits in (0.0, 1.0) or not named and lang.coverage(word) > 0.3:
        return 0
    return None


def findings(docs: DataFrame, lang: Language, weak: bool = False) -> DataFrame:
    """Every candidate of every text, described; ``weak``: with its weak label."""
    held = docs.sparkSession.sparkContext.broadcast(lang)  # DICTIONARY words and the bigrams of letters

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "start", "length", "sha256", "features"] + ["weak"] * weak
        kinds = {"doc_id": "Int64", **({"weak": "Int64"} if weak else {})}
        for b in batches:
            out = []
            for i, text, path in zip(b["doc_id"].astype("Int64"), b["text"], b["path"]):
                for start, word, before, after in candidates(text):
                    out.append((i, start, len(word), hashlib.sha256(word.encode()).hexdigest(),
                                features(word, before, after, path, held.value),
                                *([weak_label(word, before, held.value)] if weak else [])))
                    if len(out) >= 10_000:
                        yield pd.DataFrame(out, columns=names).astype(kinds)
                        out = []
            yield pd.DataFrame(out, columns=names).astype(kinds)

    shape = "doc_id long, start long, length long, sha256 string, features array<double>" + (", weak long" if weak else "")
    return _rows(docs).mapInPandas(run, shape)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), filled().alias("text"), filled("source").alias("path"))


def fit(docs: DataFrame, labels: DataFrame | None = None, trees: int = 40, depth: int = 8):
    """(language, forest or constant) from all documents, whatever their length."""
    lang = Language.of(_rows(docs))
    if labels is None:
        described = findings(docs, lang, weak=True).withColumnRenamed("weak", "label")
    else:
        known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("start").cast("long").alias("start"),
                              F.col("is_secret").cast("int").alias("label"))
        described = findings(docs, lang).join(known.dropna().groupBy("doc_id", "start").agg(F.max("label").alias("label")), ["doc_id", "start"])
    # stored for the forest's passes, in an order that no run changes: its draws follow the rows
    described = described.filter("label is not null").select(F.col("label").cast("double").alias("label"), "doc_id", "start", "sha256", "features")
    data = cut_lineage(described.repartition("doc_id").sortWithinPartitions("doc_id", "start", "sha256", "features").select("label", "features"))
    kinds = [r["label"] for r in data.select("label").distinct().collect()]
    if len(kinds) < 2:
        return lang, (kinds[0] if kinds else 0.0)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=5,
                                    predictionCol="__kind", rawPredictionCol="__raw", probabilityCol="__p")
    return lang, forest.fit(data.select("label", array_to_vector("features").alias("x")))


def scan(docs: DataFrame, model) -> DataFrame:
    """(doc_id, start, length, sha256, score, is_secret) of every candidate; the
    text of a finding is not repeated."""
    lang, forest = model
    found = findings(docs, lang)
    if isinstance(forest, float):
        scored = found.withColumn("score", F.lit(forest))
    else:
        scored = forest.transform(found.withColumn("x", array_to_vector("features")))
        scored = scored.withColumn("score", F.round(vector_to_array("__p")[1], 9))
    return scored.select("doc_id", "start", "length", "sha256", "score", (F.col("score") >= 0.5).alias("is_secret"))


def secret_digest(docs: DataFrame) -> DataFrame:
    """One row a candidate, learned from weakly labelled findings."""
    rows = docs.select("doc_id", "text", "source")
    return scan(rows, fit(rows))
