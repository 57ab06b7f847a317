"""Per-document term counting by an Arrow iterator.

A document is one row, so its term counts need no shuffle: counting inside the
row replaces an explode + per-(id, term) hash aggregation.  Built-in
higher-order functions can generate the terms (``functions/text.py``) but
cannot count them per row without quadratic work, and the measured cost of
the explode + aggregate was several times this helper's.  The token rules are
the same as the JVM expressions and the DuckDB oracle: one regex for word
tokens, one whitespace class, the same accent table.

Rows leave in slices of at most ``SLICE_ROWS``, however many terms the texts of
an Arrow batch have; what a task holds besides are the distinct terms of one text.
Several analyzers read a text in one pass.

``count_corpus`` adds up what a task's documents hold before anything leaves it,
and ``count_known`` looks terms up in a bounded vocabulary inside the task, so a corpus
is never stored or moved as one row a document and term.  Both number the terms of
a text by array operations (``make_keys``); a term becomes a string when sums leave
a task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import text as tx

SLICE_ROWS = 1 << 16
HELD_TERMS = 1 << 19  # distinct terms whose sums a task holds before it sends them on
SLICE_DOCS = 256
CACHED_WORDS = 1 << 18


def make_counter(kind: str, ngram_min: int, ngram_max: int, stop_words: tuple[str, ...] | None,
                 strip_accents: bool):
    import regex

    word_re = regex.compile(tx.WORD_TOKEN)
    stop = frozenset(stop_words or ())

    def analyze(t: str) -> str:
        t = (t or "").lower()
        return tx.fold_accents(t) if strip_accents else t

    def char_wb(t: str) -> Counter:
        # str.split() splits on exactly the whitespace class WS of text.py
        padded = [f" {w} " for w in t.split()]
        grams = [w for w in padded if len(w) < ngram_min]
        for n in range(ngram_min, ngram_max + 1):
            grams.extend([w[i:i + n] for w in padded for i in range(len(w) - n + 1)])
        return Counter(grams)

    def words(t: str) -> Counter:
        toks = word_re.findall(t)
        if stop:
            toks = [x for x in toks if x not in stop]
        grams = list(toks) if ngram_min <= 1 else []
        for n in range(2, ngram_max + 1):
            grams.extend([" ".join(toks[i:i + n]) for i in range(len(toks) - n + 1)])
        return Counter(grams)

    count = char_wb if kind == "char_wb" else words
    return lambda t: count(analyze(t))


def count_terms(docs: DataFrame, id_col: str, text_col: str, analyzers: dict[str, tuple]) -> DataFrame:
    """(id, block, term, tf): one row per distinct term of a document and
    analyzer; ``analyzers`` maps block names to the arguments of ``make_counter``."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = {block: make_counter(*args) for block, args in analyzers.items()}
        held: tuple[list, list, list, list] = ([], [], [], [])

        def flush(n: int) -> pd.DataFrame:
            # plain objects: Arrow-backed strings may come in chunks, which Spark does not take
            out = pd.DataFrame({k: pd.Series(c[:n], dtype=object) for k, c in zip((id_col, "block", "term", "tf"), held)})
            for c in held:
                del c[:n]
            return out

        for b in batches:
            for i, t in zip(b[id_col], b[text_col]):
                for block, count in counters.items():
                    found = count(t)
                    for c, v in zip(held, ([i] * len(found), [block] * len(found), found.keys(), found.values())):
                        c.extend(v)
                    while len(held[0]) >= SLICE_ROWS:
                        yield flush(SLICE_ROWS)
        yield flush(len(held[0]))

    return docs.select(id_col, text_col).mapInPandas(run, f"{id_col} {id_type}, block string, term string, tf int")


class _Known(dict):
    """Numbers of terms; -1 for any other."""

    def __missing__(self, term: str) -> int:
        return -1


def make_indexer(number: dict, kind: str, ngram_min: int, ngram_max: int, stop_words: tuple[str, ...] | None, strip_accents: bool):
    """text -> (numbers, counts) of its distinct numbered terms.  The grams of a
    word are looked up once for all texts that hold it."""
    if kind != "char_wb":
        count = make_counter(kind, ngram_min, ngram_max, stop_words, strip_accents)

        def words(t: str) -> tuple[np.ndarray, np.ndarray]:
            found = count(t)
            idx = np.fromiter((number[term] for term in found), np.int64, len(found))
            tf = np.fromiter(found.values(), np.int64, len(found))
            return idx[idx >= 0], tf[idx >= 0]

        return words
    cache: dict[str, np.ndarray] = {}

    def of(word: str) -> np.ndarray:
        got = cache.get(word)
        if got is None:
            if len(cache) >= CACHED_WORDS:
                cache.clear()
            w = f" {word} "
            found = [number[w]] if len(w) < ngram_min else []
            for n in range(ngram_min, ngram_max + 1):
                found += [number[w[i:i + n]] for i in range(len(w) - n + 1)]
            got = np.array([j for j in found if j >= 0], np.int32)
            if len(word) <= 32:
                cache[word] = got
        return got

    def chars(t: str) -> tuple[np.ndarray, np.ndarray]:
        t = (t or "").lower()
        found = Counter((tx.fold_accents(t) if strip_accents else t).split())
        parts = [of(w) for w in found]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        idx, at = np.unique(np.concatenate(parts), return_inverse=True)
        times = np.repeat(np.fromiter(found.values(), np.int64, len(found)), [len(p) for p in parts])
        return idx, np.bincount(at, times, len(idx)).astype(np.int64)

    return chars


class _Full(Exception):
    """There are no numbers left for a text's characters."""


class _WordKeys:
    """Words and pairs of words as 64-bit numbers, 32 bits a word.  ``known``: only
    words of these terms are numbered, and all others give no term."""

    def __init__(self, ngram_max: int, stop_words: tuple[str, ...] | None, strip_accents: bool, known: list[str] | None = None):
        import regex

        self.pairs, self.strip = ngram_max == 2, strip_accents
        self.any_re, self.ascii_re = regex.compile(tx.WORD_TOKEN), re.compile("[A-Za-z0-9_]{2,}")
        self.words = [""]  # by number; 0: a stop word
        self.number: dict[str, int] = {} if known is not None else _Counting(self.words)
        self.known = known is not None
        for term in known or ():
            for word in term.split(" "):
                if word not in self.number:
                    self.number[word] = len(self.words)
                    self.words.append(word)
        self.number.update(dict.fromkeys(stop_words or (), 0))

    def of(self, t: str | None) -> np.ndarray:
        t = (t or "").lower()
        t = tx.fold_accents(t) if self.strip else t
        toks = (self.ascii_re if t.isascii() else self.any_re).findall(t)
        if self.known:
            ids = np.array([self.number.get(x, -1) for x in toks], np.int64)
        else:
            ids = np.fromiter(map(self.number.__getitem__, toks), np.int64, len(toks))
        ids = ids[ids != 0]
        out = [ids[ids > 0]]
        if self.pairs:
            a, b = ids[:-1], ids[1:]
            both = (a > 0) & (b > 0)
            out.append(a[both] << 32 | b[both])
        return np.concatenate(out)

    def terms(self, keys: np.ndarray) -> list[str]:
        w = self.words
        return [f"{w[a]} {w[b]}" if a else w[b] for a, b in zip((keys >> 32).tolist(), (keys & 0xFFFFFFFF).tolist())]

    def key(self, term: str) -> int:
        ids = [self.number[x] for x in term.split(" ")]
        return 0 if len(ids) > 2 or 0 in ids else ids[0] if len(ids) == 1 else ids[0] << 32 | ids[1]


class _Counting(dict):
    """Numbers of words, given as they come; the words are listed by number."""

    def __init__(self, words: list[str]):
        super().__init__()
        self.words = words

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n


class _CharKeys:
    """Grams of 2 to 4 characters as 64-bit numbers, 16 bits a character; characters
    are numbered as they come (``known``: only those of these terms)."""

    def __init__(self, ngram_min: int, ngram_max: int, strip_accents: bool, known: list[str] | None = None):
        self.lo, self.hi, self.strip = ngram_min, ngram_max, strip_accents
        self.number, self.chars, self.n = np.zeros(0x110000, np.uint16), np.zeros(1 << 16, "<u4"), 0
        self.known = False
        self._numbers(" ")  # the number 1
        if known is not None:
            self._numbers("".join(known))
            self.known = True

    def _numbers(self, s: str) -> np.ndarray:
        cp = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<u4")
        c = self.number[cp]
        if not self.known and not c.all():
            new = np.unique(cp[c == 0])
            if self.n + len(new) >= 1 << 16:
                raise _Full
            self.number[new] = np.arange(self.n + 1, self.n + 1 + len(new))
            self.chars[self.n + 1:self.n + 1 + len(new)] = new
            self.n += len(new)
            c = self.number[cp]
        return c.astype(np.uint64)

    def of(self, t: str | None) -> np.ndarray:
        t = (t or "").lower()
        words = (tx.fold_accents(t) if self.strip else t).split()
        if not words:
            return np.zeros(0, np.uint64)
        # neighbours share the space between them: a gram may begin or end with it, not hold it inside
        c = self._numbers(f" {' '.join(words)} ")
        key, use, inside, out = c, c != 0, c != 1, []
        for n in range(2, self.hi + 1):
            m = len(c) - n + 1
            if m <= 0:
                break
            key, use = key[:m] << np.uint64(16) | c[n - 1:], use[:m] & (c[n - 1:] != 0)
            if n > 2:
                use = use & inside[n - 2:n - 2 + m]
            if n >= self.lo:
                out.append(key[use])
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def terms(self, keys: np.ndarray) -> list[str]:
        out = np.empty(len(keys), object)
        length = sum((keys >= np.uint64(1 << 16 * k)).astype(int) for k in range(4))
        for n in range(2, 5):
            at = np.flatnonzero(length == n)
            cp = [self.chars[(keys[at] >> np.uint64(16 * (n - 1 - j)) & np.uint64(0xFFFF)).astype(int)] for j in range(n)]
            s = np.stack(cp, axis=1).tobytes().decode("utf-32-le", "surrogatepass")
            out[at] = [s[i:i + n] for i in range(0, len(s), n)]
        return out.tolist()

    def key(self, term: str) -> int:
        k = 0
        for c in self._numbers(term).tolist() if self.lo <= len(term) <= self.hi else ():
            k = k << 16 | c
        return k


def make_keys(kind: str, ngram_min: int, ngram_max: int, stop_words: tuple[str, ...] | None, strip_accents: bool,
              known: list[str] | None = None) -> _WordKeys | _CharKeys | None:
    """What makes a text an array of numbers, one a term and repeat; None for terms
    that are not numbered so (runs of three words, longer grams, single characters)."""
    if kind == "char_wb":
        return _CharKeys(ngram_min, ngram_max, strip_accents, known) if 2 <= ngram_min <= 3 and ngram_max <= 4 else None
    return _WordKeys(ngram_max, stop_words, strip_accents, known) if ngram_min == 1 and ngram_max <= 2 else None


def known_indexer(number: dict[str, int], *args):
    """text -> (numbers, counts) of its distinct terms among the numbered ones."""
    try:
        keys = make_keys(*args, known=list(number))
    except _Full:
        keys = None
    if keys is None:
        return make_indexer(_Known(number), *args)
    have = np.array([keys.key(term) for term in number], np.uint64)
    order = np.argsort(have)
    order = order[np.searchsorted(have[order], 1):]  # 0: not a term of this analyzer
    have, value = have[order], np.fromiter(number.values(), np.int64, len(number))[order]

    def index(t: str) -> tuple[np.ndarray, np.ndarray]:
        found, tf = np.unique(keys.of(t).astype(np.uint64), return_counts=True)
        at = np.searchsorted(have, found)
        hit = np.flatnonzero(at < len(have))
        hit = hit[have[at[hit]] == found[hit]]
        return value[at[hit]], tf[hit]

    return index


class _Sums:
    """Documents and total counts by key; what comes is merged in when it is as
    much as a task holds."""

    def __init__(self):
        self.keys, self.df, self.tc = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.later, self.waiting = [], 0

    def add(self, keys: np.ndarray) -> None:
        found, tf = np.unique(keys.astype(np.uint64), return_counts=True)
        self.later.append((found, tf))
        self.waiting += len(found)

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.later]])
        df = np.concatenate([self.df, np.ones(self.waiting, np.int64)])
        tc = np.concatenate([self.tc, *[n for _, n in self.later]])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
        self.keys = keys[first]
        self.df, self.tc = (np.add.reduceat(x[order], first) if len(first) else x for x in (df, tc))
        self.later, self.waiting = [], 0


def count_corpus(docs: DataFrame, text_col: str, analyzers: dict[str, tuple], held_terms: int = HELD_TERMS,
                 words: dict[str, list[str]] | None = None) -> DataFrame:
    """(block, term, df, tc): documents holding the term and its total count, as
    partial sums that are still to be added by block and term.  ``words``: blocks of
    words and pairs of which only terms made of these words are counted; bounded
    by the caller, as they are broadcast."""
    only = docs.sparkSession.sparkContext.broadcast(words) if words else None

    def frames(block: str, terms: list[str], df, tc) -> Iterator[pd.DataFrame]:
        for at in range(0, len(terms), SLICE_ROWS):
            part = terms[at:at + SLICE_ROWS]
            yield pd.DataFrame({"block": pd.Series([block] * len(part), dtype=object), "term": pd.Series(part, dtype=object),
                                "df": df[at:at + len(part)], "tc": tc[at:at + len(part)]})

    def numbered(block: str) -> list:
        known = only.value.get(block) if only else None
        return [make_keys(*analyzers[block], known=known), _Sums()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = {block: numbered(block) for block in analyzers}
        plain = {block: make_counter(*args) for block, args in analyzers.items()}
        sums = {block: {} for block in analyzers}  # of terms that are not numbered: documents, total count

        def flush(block: str) -> Iterator[pd.DataFrame]:
            keys, s = held[block]
            s.merge()
            for at in range(0, len(s.keys), SLICE_ROWS):
                to = at + SLICE_ROWS
                yield from frames(block, keys.terms(s.keys[at:to]), s.df[at:to], s.tc[at:to])
            held[block] = numbered(block)

        def flush_plain(block: str) -> Iterator[pd.DataFrame]:
            both = np.array(list(sums[block].values()), np.int64).reshape(-1, 2)
            yield from frames(block, list(sums[block]), both[:, 0], both[:, 1])
            sums[block] = {}

        def count_plain(block: str, t: str) -> None:
            for term, n in plain[block](t).items():
                df, tc = sums[block].get(term, (0, 0))
                sums[block][term] = df + 1, tc + n

        for b in batches:
            for t in b[text_col]:
                for block in analyzers:
                    if held[block][0] is None:
                        count_plain(block, t)
                    else:
                        try:
                            found = held[block][0].of(t)
                        except _Full:
                            yield from flush(block)
                            try:
                                found = held[block][0].of(t)
                            except _Full:  # a text of more characters than there are numbers
                                held[block] = numbered(block)
                                count_plain(block, t)
                                continue
                        s = held[block][1]
                        s.add(found)
                        if s.waiting >= held_terms:
                            s.merge()
                            if len(s.keys) >= held_terms:
                                yield from flush(block)
                    if len(sums[block]) >= held_terms:
                        yield from flush_plain(block)
        for block in analyzers:
            if held[block][0] is not None:
                yield from flush(block)
            yield from flush_plain(block)

    return docs.select(text_col).mapInPandas(run, "block string, term string, df long, tc long")


@dataclass
class Weights:
    """TF-IDF of counted terms: the idf by number; a block's numbers lie in a span
    (from, to, whether counts are taken sublinear) and have unit length together."""

    idf: np.ndarray
    spans: list[tuple[int, int, bool]]

    def of(self, idx: np.ndarray, tf: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Weights of the entries of ``n`` documents; ``row``: an entry's document."""
        out = np.zeros(len(idx))
        for lo, hi, sublinear in self.spans:
            mine = np.flatnonzero((idx >= lo) & (idx < hi))
            w = (1.0 + np.log(tf[mine]) if sublinear else tf[mine].astype(float)) * self.idf[idx[mine]]
            norm = np.sqrt(np.bincount(row[mine], w * w, n))
            out[mine] = w / norm[row[mine]]
        return out


def count_known(docs: DataFrame, id_col: str, text_col: str, blocks: list[tuple[str, tuple]], vocabulary: dict[str, int],
                weights: Weights | None = None) -> DataFrame:
    """(id, idx, tf), a row a document: numbers of its kept terms and their counts;
    with ``weights`` (id, idx, w).  ``blocks``: prefix and arguments of
    ``make_counter``; ``vocabulary``: numbers of the prefixed terms, bounded by
    the caller."""
    id_type = docs.schema[id_col].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(
        ([{t[len(prefix):]: v for t, v in vocabulary.items() if t.startswith(prefix)} for prefix, _ in blocks], weights))
    value = "w" if weights else "tf"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, weigh = held.value
        index = [known_indexer(k, *args) for k, (_, args) in zip(known, blocks)]
        for b in batches:
            for at in range(0, len(b), SLICE_DOCS):
                part = b.iloc[at:at + SLICE_DOCS]
                idx, out = [], []
                for t in part[text_col]:
                    found = [f(t) for f in index]
                    i, tf = (np.concatenate(x) for x in zip(*found))
                    idx.append(i.astype(np.int32))
                    out.append(weigh.of(i, tf, np.zeros(len(i), np.int64), 1) if weigh else tf.astype(np.int32))
                yield pd.DataFrame({id_col: part[id_col].to_numpy(), "idx": pd.Series(idx, dtype=object),
                                    value: pd.Series(out, dtype=object)})

    return docs.select(id_col, text_col).mapInPandas(run, f"{id_col} {id_type}, idx array<int>, {value} array<{'double' if weights else 'int'}>")
