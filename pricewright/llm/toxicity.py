"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is a sequence of lower-cased letter runs.  Each word enters by a hashed
word vector and by the mean of hashed vectors of its beginnings and endings (up
to 6 and up to 4 characters).  All overlapping windows of ``WINDOW`` words
(stride half a window) run through a forward and a backward GRU, attention
pools the states, and a linear layer gives a logit for each window.

Training (numpy): a document's logit is the mean of its ``TOP`` highest window
logits; each step scores all windows of its documents and learns through those
windows.  A logistic layer then turns a document's highest logits, its expected
number of toxic windows and its length into a probability.  The network learns
from a bounded, documented sample: ``max_positive`` and ``max_negative`` labelled
documents of at most ``max_chars`` characters, those with the least hash draws.
Scoring reads every word.

Edge cases: null, empty or letterless texts score as a document with one empty
window; very long texts run slice by slice, with the windows of the whole text;
without labels of both kinds every score is the share of toxic labels (0 without
labels).  Every row is scored by itself: repeated rows repeat their scores, an
empty table gives an empty result, and only ``__score`` replaces a further column
of its name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filled, fold, mix64, slices
from .labelling import logistic, sample

WORD = re.compile(r"[^\W\d_]+")
WINDOW, STRIDE, TOP = 32, 16, 4
DIM, HIDDEN, ATTENTION = 8, 8, 8
ROWS = 1 << 20  # hash values of words, and of parts
#: A word or part that fewer sample documents hold has no vector of its own, so
#: that it can't be learned by heart.
MIN_DOCS = 4
PAD = 0
HIGHEST = 8  # window logits of a document that its features use
HELD = 200_000
BLOCK = 4096
SLICE = 1 << 20  # characters of a long text that are taken at once
TAKEN = 50_000  # words whose windows run together


def words_of(text: str, size: int = SLICE) -> Iterator[list[str]]:
    """Words of a text, slice by slice; a word that a slice cuts goes whole to the
    next one."""
    if len(text) <= size:
        yield WORD.findall(text.lower())
        return
    held: list[str] = []
    for part in slices(text, size):
        at = len(part)
        while at and WORD.match(part, at - 1):
            at -= 1
        if at:
            yield WORD.findall("".join([*held, part[:at]]).lower())
            held = []
        held.append(part[at:])
    yield WORD.findall("".join(held).lower())


def word_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the words' own vectors, rows of their parts, and which parts are
    there: beginnings of 1 to 6 characters (1 only for a single one), endings of
    2 to 4."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    own = np.fromiter((zlib.crc32(w.encode("utf-8")) for w in words), np.int64, len(words)) % ROWS
    rows, there = [], []
    for text, longest, seed in ((words, 6, 1), ([w[:-5:-1] for w in words], 4, 2)):
        chars = np.array(text, dtype=f"U{longest}").view(np.uint32).reshape(len(words), longest).astype(np.uint64)
        h = np.full(len(words), seed, np.uint64)
        for k in range(longest):
            h = mix64(h + chars[:, k])
            rows.append(h % np.uint64(ROWS))
            there.append((size > k) & ((k > 0) | (seed == 1) & (size == 1)))
    return own, np.stack(rows, 1).astype(np.int64), np.stack(there, 1).astype(np.float32)


def windows(idx: np.ndarray) -> np.ndarray:
    """All overlapping windows over word indices, padded at the end."""
    n = max(1, -(-(len(idx) - STRIDE) // STRIDE)) if len(idx) > WINDOW - STRIDE else 1
    padded = np.full((n - 1) * STRIDE + WINDOW, PAD, np.int32)
    padded[:len(idx)] = idx
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class Network:
    """Weights, and the forward pass over word indices."""

    def __init__(self, n_words: int = 0, n_parts: int = 0, seed: int = 7):
        """Vectors for so many words and parts; row 0 stays zero, for all others."""
        g = np.random.default_rng(seed)
        f = lambda *shape, by: (g.standard_normal(shape) * by).astype(np.float32)
        self.word, self.part = f(n_words + 1, DIM, by=0.01), f(n_parts + 1, DIM, by=0.01)
        self.word[0] = self.part[0] = 0
        #: row of each hash value
        self.word_row, self.part_row = np.zeros(ROWS, np.int32), np.zeros(ROWS, np.int32)
        self.p = {}
        for d in ("f", "b"):
            self.p[f"W{d}"] = f(2 * DIM, 3 * HIDDEN, by=0.3)
            self.p[f"U{d}"] = f(HIDDEN, 3 * HIDDEN, by=0.3)
            self.p[f"b{d}"] = np.zeros(3 * HIDDEN, np.float32)
        self.p |= {"A": f(2 * HIDDEN, ATTENTION, by=0.3), "a": np.zeros(ATTENTION, np.float32), "v": f(ATTENTION, by=0.3),
                   "o": f(2 * HIDDEN, by=0.3), "c": np.zeros(1, np.float32)}

    def inputs(self, own: np.ndarray, parts: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Input vector of each word, from its rows."""
        mean = np.einsum("wpd,wp->wd", self.part[self.part_row[parts]], there / there.sum(axis=1, keepdims=True))
        return np.concatenate([self.word[self.word_row[own]], mean], axis=1)

    def gates(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x @ self.p["Wf"] + self.p["bf"], x @ self.p["Wb"] + self.p["bb"]], axis=1)

    def pad_gates(self) -> np.ndarray:
        """A padded step leaves the state as it is."""
        g = np.zeros((1, 6 * HIDDEN), np.float32)
        g[0, HIDDEN:2 * HIDDEN] = g[0, 4 * HIDDEN:5 * HIDDEN] = 30
        return g

    def _run(self, gx: np.ndarray, u: np.ndarray, order, keep: list | None = None) -> np.ndarray:
        t, b = gx.shape[:2]
        h = np.zeros((b, HIDDEN), np.float32)
        out = np.empty((t, b, HIDDEN), np.float32)
        for k in order:
            hu = h @ u
            rz = sigmoid(gx[k, :, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
            r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
            n = np.tanh(gx[k, :, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
            if keep is not None:
                keep.append((k, h, r, z, n, hu[:, 2 * HIDDEN:]))
            h = n + z * (h - n)
            out[k] = h
        return out

    def pooled(self, gx: np.ndarray, pad: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Window logits; gx (steps, windows, gates), pad (steps, windows)."""
        steps = range(len(gx))
        kf, kb = ([], []) if keep is not None else (None, None)
        s = np.concatenate([self._run(gx[:, :, :3 * HIDDEN], self.p["Uf"], steps, kf),
                            self._run(gx[:, :, 3 * HIDDEN:], self.p["Ub"], reversed(steps), kb)], axis=2)
        e = np.tanh(s @ self.p["A"] + self.p["a"])
        score = e @ self.p["v"] - np.float32(1e4) * pad
        score -= score.max(axis=0)
        w = np.exp(score)
        w /= w.sum(axis=0)
        pool = np.einsum("tb,tbh->bh", w, s)
        if keep is not None:
            keep.update(kf=kf, kb=kb, s=s, e=e, w=w, pool=pool)
        return pool @ self.p["o"] + self.p["c"][0]

    def logits(self, table: np.ndarray, win: np.ndarray) -> np.ndarray:
        out = [self.pooled(table[win[at:at + BLOCK].T], (win[at:at + BLOCK].T == PAD).astype(np.float32))
               for at in range(0, len(win), BLOCK)]
        return np.concatenate(out)

    def gradients(self, table: np.ndarray, win: np.ndarray, weigh) -> tuple[dict, np.ndarray, np.ndarray]:
        """Gradients of the weights and, for each step and window, of its input
        gates; ``weigh`` maps window logits to their loss gradients."""
        keep: dict = {}
        pad = (win.T == PAD).astype(np.float32)
        logit = self.pooled(table[win.T], pad, keep)
        d = weigh(logit).astype(np.float32)
        s, e, w, pool, p = keep["s"], keep["e"], keep["w"], keep["pool"], self.p
        g = {"o": pool.T @ d, "c": d.sum(keepdims=True)}
        dpool = d[:, None] * p["o"]
        ds = w[:, :, None] * dpool
        dw = np.einsum("tbh,bh->tb", s, dpool)
        dscore = w * (dw - (w * dw).sum(axis=0))
        g["v"] = np.einsum("tb,tba->a", dscore, e)
        de = dscore[:, :, None] * p["v"] * (1 - e * e)
        g["A"], g["a"] = np.einsum("tbh,tba->ha", s, de), de.sum(axis=(0, 1))
        ds += de @ p["A"].T
        dgx = np.zeros((len(s), len(win), 6 * HIDDEN), np.float32)
        for part, steps, u, name in ((slice(0, HIDDEN), keep["kf"], p["Uf"], "f"), (slice(HIDDEN, None), keep["kb"], p["Ub"], "b")):
            to = slice(0, 3 * HIDDEN) if name == "f" else slice(3 * HIDDEN, None)
            du, dh = np.zeros_like(u), np.zeros((len(win), HIDDEN), np.float32)
            for k, h, r, z, n, hun in reversed(steps):
                dh = dh + ds[k, :, part]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * hun * r * (1 - r)
                dhu = np.concatenate([dr, dz, dn * r], axis=1)
                dgx[k, :, to] = np.concatenate([dr, dz, dn], axis=1)
                du += h.T @ dhu
                dh = dh * z + dhu @ u.T
            g[f"U{name}"] = du
        dgx *= (1 - pad)[:, :, None]
        return g, dgx, logit


class Words:
    """Indices of words and the input gates that belong to them (0: padding)."""

    def __init__(self, net: Network):
        self.net = net
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.repeat(self.net.pad_gates(), 1, axis=0)
        self.used = 1

    def of(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.index]
        if new:
            rows = self.net.gates(self.net.inputs(*word_rows(new)))
            if self.used + len(new) > len(self.table):
                grown = np.empty((2 * (self.used + len(new)), rows.shape[1]), np.float32)
                grown[:self.used] = self.table[:self.used]
                self.table = grown
            self.table[self.used:self.used + len(new)] = rows
            self.index.update(zip(new, range(self.used, self.used + len(new))))
            self.used += len(new)
        return np.fromiter(map(self.index.__getitem__, words), np.int32, len(words))


class Summary:
    """What a document's features need of its window logits."""

    def __init__(self):
        self.top, self.expected, self.n = np.zeros(0, np.float32), 0.0, 0

    def add(self, logits: np.ndarray) -> None:
        self.expected += float(sigmoid(logits).sum(dtype=np.float64))
        self.n += len(logits)
        self.top = np.sort(np.concatenate([self.top, logits]))[::-1][:HIGHEST]

    def features(self) -> list[float]:
        t = np.clip(self.top.astype(float), -12, 12)
        return [t[0], t[:2].mean(), t[:TOP].mean(), t.mean(), np.log1p(self.expected), np.log(self.n),
                np.log((self.expected + 0.05) / self.n)]


class Model:
    def __init__(self, net: Network, weights: np.ndarray, mean: np.ndarray, spread: np.ndarray):
        self.net, self.weights, self.mean, self.spread = net, weights, mean, spread

    def probability(self, f: np.ndarray) -> np.ndarray:
        x = (np.atleast_2d(f) - self.mean) / self.spread
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def summaries(net: Network, known: Words, texts: list[str], size: int = SLICE) -> list[Summary]:
    """Scores all windows of the texts; windows of short texts run together.  A
    text of several slices has the windows of the whole text: words that a window
    to come needs go on to the next slice."""
    out = [Summary() for _ in texts]
    parts: list[tuple[int, list[str]]] = []
    n = 0

    def take() -> None:
        nonlocal n
        if known.used > HELD:
            known.clear()
        known.of([w for _, words in parts for w in words])
        win = [windows(known.of(words)) for _, words in parts]
        logits = net.logits(known.table, np.concatenate(win))
        at = 0
        for (k, _), w in zip(parts, win):
            out[k].add(logits[at:at + len(w)])
            at += len(w)
        parts.clear()
        n = 0

    def put(k: int, words: list[str]) -> None:
        nonlocal n
        parts.append((k, words))
        n += len(words)
        if n > TAKEN:
            take()

    for k, text in enumerate(texts):
        if len(text) <= size:
            put(k, WORD.findall(text.lower()))
            continue
        rest, first = [], True
        for words in words_of(text, size):
            words = rest + words
            full = max(0, (len(words) - WINDOW) // STRIDE + 1)  # windows that no later word can change
            if full:
                put(k, words[:(full - 1) * STRIDE + WINDOW])
                first = False
            rest = words[full * STRIDE:]
        if first or len(rest) > STRIDE:
            put(k, rest)
    if parts:
        take()
    return out


def train(texts: list[str], labels: list[int], steps: int = 500, batch: int = 32, rate: float = 0.01, seed: int = 7) -> Model:
    y = np.array(labels, float)
    share = float(y.mean()) if len(y) else 0.0
    if len(set(labels)) < 2:
        w = np.zeros(8)
        w[-1] = np.log(share / (1 - share)) if 0 < share < 1 else (30 if share else -30)
        return Model(Network(), w, np.zeros(7), np.ones(7))
    # words of the sample by index (0: padding), with their rows in padded form
    index: dict[str, int] = {}
    docs = []
    for t in texts:
        ws = [w for part in words_of(t) for w in part]
        docs.append(windows(np.fromiter((index.setdefault(w, len(index) + 1) for w in ws), np.int32, len(ws))))
    own_hash, part_hash, there = word_rows(list(index))
    # documents that hold each word and part; equal texts count once
    in_words, in_parts = np.zeros(ROWS, np.int32), np.zeros(ROWS, np.int32)
    for k in {t: k for k, t in enumerate(texts)}.values():
        at = np.unique(docs[k][docs[k] != PAD]) - 1
        in_words[np.unique(own_hash[at])] += 1
        in_parts[np.unique(part_hash[at][there[at] > 0])] += 1
    common, common_parts = np.flatnonzero(in_words >= MIN_DOCS), np.flatnonzero(in_parts >= MIN_DOCS)
    net = Network(len(common), len(common_parts), seed)
    net.word_row[common], net.part_row[common_parts] = np.arange(1, len(common) + 1), np.arange(1, len(common_parts) + 1)
    own_rows, part_rows = net.word_row[own_hash], net.part_row[part_hash]
    g = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    seen_word, seen_part = (np.full(len(v), 1e-2, np.float32) for v in (net.word, net.part))
    heavy = 0.3 / share, 0.7 / (1 - share)  # toxic documents count as three in ten
    step = 0
    while step < steps:
        order = g.permutation(len(docs))
        for at in range(0, len(order), batch):
            chosen = order[at:at + batch]
            used, win = np.unique(np.concatenate([docs[k].reshape(-1) for k in chosen]), return_inverse=True)
            if used[0] != PAD:
                used, win = np.concatenate([[PAD], used]), win + 1
            win = win.reshape(-1, WINDOW).astype(np.int32)
            step += 1
            if len(used) == 1:
                continue
            at_word = used[1:] - 1
            x = net.inputs(own_hash[at_word], part_hash[at_word], there[at_word])
            table = np.concatenate([net.pad_gates(), net.gates(x)])
            logit = net.logits(table, win)
            starts = np.concatenate([[0], np.cumsum([len(docs[k]) for k in chosen])])
            pick, doc_of = [], []
            for j in range(len(chosen)):
                l = logit[starts[j]:starts[j + 1]]
                best = np.argsort(-l, kind="stable")[:TOP] + starts[j]
                pick.extend(best)
                doc_of.extend([j] * len(best))
            doc_of = np.array(doc_of)
            sizes = np.bincount(doc_of)
            target = y[chosen]
            weight = np.where(target == 1, *heavy) / len(chosen)

            def weigh(l):
                mean = np.bincount(doc_of, l) / sizes
                d = (1 / (1 + np.exp(-np.clip(mean, -30, 30))) - target) * weight
                return d[doc_of] / sizes[doc_of]

            grads, dgx, _ = net.gradients(table, win[pick], weigh)
            flat, where = dgx.reshape(-1, 6 * HIDDEN), win[pick].T.reshape(-1)
            dg = np.zeros_like(table)
            np.add.at(dg, where, flat)
            dg = dg[1:]
            df, db = dg[:, :3 * HIDDEN], dg[:, 3 * HIDDEN:]
            grads |= {"Wf": x.T @ df, "bf": df.sum(axis=0), "Wb": x.T @ db, "bb": db.sum(axis=0)}
            dx = df @ net.p["Wf"].T + db @ net.p["Wb"].T
            for k, d in grads.items():  # Adam
                m, v = moments[k]
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                net.p[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            # Adagrad on the rows that took part
            touched = np.flatnonzero(np.abs(dx).sum(axis=1))
            if len(touched):
                w = at_word[touched]
                _adagrad(net.word, seen_word, own_rows[w], dx[touched, :DIM])
                share_of = there[w] / there[w].sum(axis=1, keepdims=True)
                _adagrad(net.part, seen_part, part_rows[w].reshape(-1),
                         (dx[touched, None, DIM:] * share_of[:, :, None]).reshape(-1, DIM))
    known = Words(net)
    f = np.array([s.features() for s in summaries(net, known, texts)])
    mean, spread = f.mean(axis=0), f.std(axis=0) + 1e-6
    return Model(net, logistic((f - mean) / spread, y, ridge=1e-3, weight=np.where(y == 1, 2.5, 1.0)), mean, spread)


def _adagrad(table: np.ndarray, seen: np.ndarray, rows: np.ndarray, grad: np.ndarray, rate: float = 0.1) -> None:
    uniq, inverse = np.unique(rows, return_inverse=True)
    total = np.zeros((len(uniq), table.shape[1]), np.float32)
    np.add.at(total, inverse, grad)
    seen[uniq] += (total * total).mean(axis=1)
    table[uniq] -= rate * total / np.sqrt(seen[uniq])[:, None]
    table[0] = 0


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``__score`` beside the columns of the documents."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # some MB: bounded by the sample

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = held.value
        known = Words(m.net)
        for t in texts:
            found = summaries(m.net, known, list(t))
            yield pd.Series(m.probability(np.array([s.features() for s in found])) if found else [], dtype="float64")

    return docs.withColumn("__score", run(filled()))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = 1500, max_negative: int = 2500,
        max_chars: int = 200_000) -> Model:
    """Learns ``labels.toxic`` outside the held-out fold."""
    rows, _ = sample(docs, labels, "toxic", 1, 3, {1: max_positive, 0: max_negative}, max_chars)
    return train([r["text"] for r in rows], [r["y"] for r in rows])


def toxicity_digest(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row a document: its toxicity."""
    rows = docs.select("doc_id", "text")
    out = score(rows, fit(rows, labels))
    value = F.round("__score", 9)
    return out.select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), value.alias("score"),
                      (value >= threshold).cast("int").alias("predicted"))
