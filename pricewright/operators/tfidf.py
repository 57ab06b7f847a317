"""TF-IDF in long form (rows 54-55, 59-63).

A document-term matrix is kept as rows ``(sample_id, term, weight)``: the
natural sparse layout for a distributed table, with no vocabulary index to
assign and no driver-side matrix.

Plan shape:

1. ``repartition(id)`` of the raw text once for all blocks, stored for the two
   passes that follow; terms are counted inside each document (an Arrow iterator,
   ``functions/counting.py``);
2. document frequency and corpus count per term: added up in every task, then a
   hash aggregation (a term costs one row a task, wherever it is found); with a
   cap on the terms, words before pairs, and pairs of frequent words only;
3. the vocabulary filter (min/max df) and top-``max_features`` by corpus count
   (ties: term ascending) — ``TakeOrderedAndProject``, bounded by the cap;
4. a second pass over the texts that counts again, looks the terms up in the
   broadcast vocabulary and gives one row a document (``idx``, ``w``): sublinear
   tf × smoothed idf and an L2 norm.  The long form is that row, exploded.  Without
   a cap that bounds the broadcast, counts and vocabulary are joined instead.

Weights follow the smoothed, sublinear definition: (1 + ln tf) ·
(ln((1 + n) / (1 + df)) + 1), then each row scaled to unit L2 norm.  The model
is fitted on the training documents and applied to any documents.
"""

from __future__ import annotations

import dataclasses
import functools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.counting import Weights, count_corpus, count_known, count_terms
from ..session import BROADCAST_MAX_ROWS, cut_lineage


@dataclass(frozen=True)
class Analyzer:
    """How a text becomes terms."""

    kind: str = "word"  # "word" or "char_wb"
    ngram_min: int = 1
    ngram_max: int = 1
    stop_words: bool = False
    strip_accents: bool = True

    def terms(self, text: str | Column) -> Column:
        t = tx.analyzer_text(text, accents=self.strip_accents)
        if self.kind == "char_wb":
            return tx.char_wb_ngrams(t, self.ngram_min, self.ngram_max)
        toks = tx.word_tokens(t)
        if self.stop_words:
            toks = tx.remove_stop_words(toks)
        if self.ngram_min != 1:
            raise ValueError("word n-grams start at 1")
        return tx.word_ngrams(toks, self.ngram_max) if self.ngram_max > 1 else toks


@dataclass(frozen=True)
class TfidfParams:
    analyzer: Analyzer = Analyzer()
    min_df: float = 1  # int-like: documents; < 1.0: fraction of documents
    max_df: float = 1.0  # <= 1.0: fraction of documents; > 1: documents
    max_features: int | None = None
    sublinear_tf: bool = True
    prefix: str = ""  # "w:" / "c:" keeps blocks apart when stacked


def _spread(docs: DataFrame, text: str | Column, id_col: str, partitions: int | None = None) -> DataFrame:
    """(id, _text), hash-partitioned by id: the text is the smallest thing to move."""
    base = docs.select(F.col(id_col), tx.col_of(text).alias("_text"))
    # an explicit count: AQE must not merge these partitions, the next stage is
    # CPU-bound per document (set spark.sql.shuffle.partitions to the data size)
    return base.repartition(partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), id_col)


def _args(a: Analyzer) -> tuple:
    return a.kind, a.ngram_min, a.ngram_max, tx.spark_stop_words() if a.stop_words else None, a.strip_accents


def counts_by_block(docs: DataFrame, text: str | Column, analyzers: dict[str, Analyzer], id_col: str = "sample_id",
                    partitions: int | None = None) -> DataFrame:
    """(id, block, term, tf) for all analyzers from one shuffle of the texts.
    Counting happens inside each document, so the rows come out already grouped
    by id for every later per-document step."""
    return count_terms(_spread(docs, text, id_col, partitions), id_col, "_text", {block: _args(a) for block, a in analyzers.items()})


def term_counts(docs: DataFrame, text: str | Column, analyzer: Analyzer, id_col: str = "sample_id",
                partitions: int | None = None) -> DataFrame:
    """(id, term, tf) of one analyzer."""
    return counts_by_block(docs, text, {"": analyzer}, id_col, partitions).drop("block")


def stats_by_block(texts: DataFrame, analyzers: dict[str, Analyzer], words: dict[str, list[str]] | None = None) -> DataFrame:
    """(block, term, df, tc) over the column ``_text``; ``words`` as in ``count_corpus``."""
    parts = count_corpus(texts, "_text", {block: _args(a) for block, a in analyzers.items()}, words=words)
    return parts.groupBy("block", "term").agg(F.sum("df").alias("df"), F.sum("tc").alias("tc"))


def frequent_words(stats: DataFrame, n_docs: Column, p: TfidfParams) -> list[str] | None:
    """The words that a kept pair can be made of, from the statistics of the words
    alone.  A pair is no more frequent than its words, in documents and in total:
    where ``max_features`` words are kept, a pair with a word rarer than the last of
    them comes after all of these.  None: too many to broadcast."""
    kept = stats.filter((F.col("df") >= _least_df(p, n_docs)) & (F.col("df") <= _bound(p.max_df, n_docs)))
    top = kept.orderBy(F.desc("tc")).limit(p.max_features).agg(F.count(F.lit(1)).alias("n"), F.min("tc").alias("tc")).first()
    least = top["tc"] if top["n"] == p.max_features else 0
    able = stats.filter((F.col("df") >= _least_df(p, n_docs)) & (F.col("tc") >= least)).select("term").limit(BROADCAST_MAX_ROWS + 1)
    words = [r["term"] for r in able.collect()]
    return words if len(words) <= BROADCAST_MAX_ROWS else None


def vocabulary_stats(texts: DataFrame, n_docs: Column, blocks: list[TfidfParams]) -> DataFrame:
    """(block, term, df, tc), stored: the terms that ``min_df`` lets through.  Blocks of
    words and pairs with a cap are counted in two passes, words first; pairs that
    cannot be among the kept terms are then never counted or moved."""

    def stored(stats: DataFrame, some: list[TfidfParams]) -> DataFrame:
        any_of = [(F.col("block") == p.prefix) & (F.col("df") >= _least_df(p, n_docs)) for p in some]
        return cut_lineage(stats.filter(functools.reduce(Column.__or__, any_of)))

    paired = [p for p in blocks if p.max_features and (p.analyzer.kind, p.analyzer.ngram_min, p.analyzer.ngram_max) == ("word", 1, 2)]
    first = {p.prefix: dataclasses.replace(p.analyzer, ngram_max=1) if p in paired else p.analyzer for p in blocks}
    stats = stored(stats_by_block(texts, first), blocks)
    if not paired:
        return stats
    words = {p.prefix: frequent_words(stats.filter(F.col("block") == p.prefix), n_docs, p) for p in paired}
    both = stored(stats_by_block(texts, {p.prefix: p.analyzer for p in paired}, {b: w for b, w in words.items() if w is not None}), paired)
    return stats.filter(~F.col("block").isin(list(words))).unionByName(both)


def corpus_stats(docs: DataFrame, text: str | Column, analyzer: Analyzer, id_col: str = "sample_id") -> DataFrame:
    """(term, df, tc): documents holding the term and its total count."""
    return stats_by_block(_spread(docs, text, id_col), {"": analyzer}).drop("block")


def _bound(v: float, n: Column) -> Column:
    return F.lit(float(v)) * n if isinstance(v, float) and v <= 1.0 else F.lit(float(v))


def _least_df(p: TfidfParams, n_docs: Column) -> Column:
    return F.lit(float(p.min_df)) * n_docs if isinstance(p.min_df, float) and p.min_df < 1.0 else F.lit(p.min_df)


def fit_vocabulary(stats: DataFrame, n_docs: Column, p: TfidfParams) -> DataFrame:
    """(term, df, tc, idf) for the kept terms of ``corpus_stats``.

    ``n_docs`` is a scalar Column (a scalar subquery over the training ids), so
    the document count is computed inside the same plan rather than collected.
    """
    hi = _bound(p.max_df, n_docs)
    kept = stats.filter((F.col("df") >= _least_df(p, n_docs)) & (F.col("df") <= hi))
    if p.max_features is not None:
        kept = kept.orderBy(F.desc("tc"), F.asc("term")).limit(p.max_features)
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return kept.select(F.concat(F.lit(p.prefix), "term").alias("term"), "df", "tc", idf.alias("idf"))


def transform(tf: DataFrame, vocab: DataFrame, p: TfidfParams, id_col: str = "sample_id") -> DataFrame:
    """(id, term, weight) with unit L2 norm per document; unseen terms dropped."""
    v = vocab.select("term", "idf")
    if p.max_features is not None and p.max_features <= BROADCAST_MAX_ROWS:
        v = F.broadcast(v)  # size bounded by max_features
    t = tf.select(id_col, F.concat(F.lit(p.prefix), "term").alias("term"), "tf")
    tfw = (F.lit(1.0) + F.log("tf")) if p.sublinear_tf else F.col("tf").cast("double")
    w = t.join(v, "term").select(id_col, "term", (tfw * F.col("idf")).alias("w"))
    # the counts are partitioned by id already: this window adds no shuffle
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", (F.col("w") / norm).alias("weight"))


def n_docs_of(docs: DataFrame, id_col: str = "sample_id") -> Column:
    return docs.agg(F.count(F.lit(1))).scalar()


@dataclass
class Fitted:
    """What was fitted on the training texts, and the texts of all sets, stored."""

    blocks: list[TfidfParams]
    vocab: DataFrame  # (term, df, tc, idf, idx)
    texts: list[DataFrame]
    id_col: str

    @property
    def bounded(self) -> bool:
        return _bounded(self.blocks)

    def _numbers(self) -> tuple[dict[str, int], Weights]:
        rows = self.vocab.select("term", "idx", "idf").orderBy("idx").collect()  # bounded by the blocks' max_features
        spans = []
        for p in self.blocks:  # numbers follow the terms, so a prefix has a span
            mine = [r["idx"] for r in rows if r["term"].startswith(p.prefix)]
            spans.append((min(mine, default=0), max(mine, default=-1) + 1, p.sublinear_tf))
        return {r["term"]: r["idx"] for r in rows}, Weights(np.array([r["idf"] for r in rows], float), spans)

    def counted(self) -> tuple[list[DataFrame], Weights]:
        """(id, idx, tf) of every set, a row a document, and what makes weights of them."""
        known, weights = self._numbers()
        return [count_known(t, self.id_col, "_text", [(p.prefix, _args(p.analyzer)) for p in self.blocks], known) for t in self.texts], weights

    def arrays(self) -> list[DataFrame]:
        """(id, idx, w) of every set, a row a document."""
        known, weights = self._numbers()
        return [count_known(t, self.id_col, "_text", [(p.prefix, _args(p.analyzer)) for p in self.blocks], known, weights) for t in self.texts]


def _bounded(blocks: list[TfidfParams]) -> bool:
    return sum(p.max_features or BROADCAST_MAX_ROWS + 1 for p in blocks) <= BROADCAST_MAX_ROWS


def fit_blocks(train: DataFrame, others: list[DataFrame], text: str | Column, blocks: list[TfidfParams], id_col: str = "sample_id") -> Fitted:
    """Fits every block on ``train``; a text is read and moved once for all."""
    if len({p.prefix for p in blocks}) != len(blocks):
        raise ValueError("blocks need prefixes of their own")
    texts = [cut_lineage(_spread(d, text, id_col)) for d in (train, *others)]  # read by two passes
    n = n_docs_of(texts[0], id_col)
    stats = vocabulary_stats(texts[0], n, blocks)
    vocabs = [fit_vocabulary(stats.filter(F.col("block") == p.prefix).drop("block"), n, p) for p in blocks]
    vocab = functools.reduce(DataFrame.unionByName, vocabs)
    if _bounded(blocks):  # one ordered window over a bounded table
        vocab = cut_lineage(vocab)
        vocab = cut_lineage(vocab.withColumn("idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int")))
    return Fitted(blocks, vocab, texts, id_col)


def long_form(arrays: DataFrame, vocab: DataFrame, id_col: str = "sample_id") -> DataFrame:
    """(id, term, weight) of rows (id, idx, w)."""
    e = arrays.select(id_col, F.explode(F.arrays_zip("idx", "w")).alias("e")).select(id_col, "e.idx", "e.w")
    return e.join(F.broadcast(vocab.select("idx", "term")), "idx").select(id_col, "term", F.col("w").alias("weight"))  # bounded


def fit_transform_blocks(train: DataFrame, others: list[DataFrame], text: str | Column, blocks: list[TfidfParams],
                         id_col: str = "sample_id"):
    """Fit every block on ``train``; return (vocabulary, weights of train, weights
    of each other set) with the blocks stacked, apart by their prefixes.  A text
    is read and moved once for all blocks."""
    fitted = fit_blocks(train, others, text, blocks, id_col)
    if fitted.bounded:
        return fitted.vocab.drop("idx"), [long_form(a, fitted.vocab, id_col) for a in fitted.arrays()]
    vocab = cut_lineage(fitted.vocab)
    outs = []
    for t in fitted.texts:
        counts = counts_by_block(t, "_text", {p.prefix: p.analyzer for p in blocks}, id_col)
        parts = [transform(counts.filter(F.col("block") == p.prefix).drop("block"),
                           vocab.filter(F.startswith("term", F.lit(p.prefix))), p, id_col) for p in blocks]
        outs.append(functools.reduce(DataFrame.unionByName, parts))
    return vocab, outs


def fit_transform(train: DataFrame, others: list[DataFrame], text: str | Column, p: TfidfParams,
                  id_col: str = "sample_id"):
    """Fit on ``train``; return (vocabulary, weights of train, weights of each other set)."""
    return fit_transform_blocks(train, others, text, [p], id_col)


def invalid(p: TfidfParams) -> str | None:
    """Why a setting cannot be used, or None."""
    if p.max_features is not None and p.max_features <= 0:
        return "max_features must be positive"
    if isinstance(p.max_df, float) and not 0 < p.max_df <= 1.0:
        return "fractional max_df must be in (0, 1]"
    if isinstance(p.min_df, float) and not 0 <= p.min_df <= 1.0:
        return "fractional min_df must be in [0, 1]"
    if p.analyzer.ngram_min > p.analyzer.ngram_max:
        return "ngram_min > ngram_max"
    return None


@dataclass(frozen=True)
class Rung:
    """One setting of a ladder, tried."""

    params: TfidfParams
    reason: str | None  # why it was not usable
    n_terms: int
    chosen: bool


def kept_stats(train: DataFrame, text: str | Column, tried: list[TfidfParams], id_col: str = "sample_id") -> dict[Analyzer, DataFrame]:
    """(term, df, tc) for the analyzers of the valid settings, from one reading of
    the texts; stored are the terms that a setting's ``min_df`` lets through."""
    valid = [p for p in tried if invalid(p) is None]
    analyzers = {str(k): a for k, a in enumerate(dict.fromkeys(p.analyzer for p in valid))}
    if not analyzers:
        return {}
    n = n_docs_of(train, id_col)
    stats = stats_by_block(_spread(train, text, id_col), analyzers)
    any_of = [(F.col("block") == block) & (F.col("df") >= _least_df(p, n)) for block, a in analyzers.items() for p in valid if p.analyzer == a]
    stats = cut_lineage(stats.filter(functools.reduce(Column.__or__, any_of)))
    return {a: stats.filter(F.col("block") == block).drop("block") for block, a in analyzers.items()}


def climb(train: DataFrame, text: str | Column, ladder: list[TfidfParams], id_col: str = "sample_id",
          stats: dict[Analyzer, DataFrame] | None = None) -> list[Rung]:
    """Tries the settings in order; the first valid one with any term is chosen,
    and none may be: the block is then empty (width 0).  ``stats``: what
    ``kept_stats`` gave for these settings, if other ladders share it."""
    stats = kept_stats(train, text, ladder, id_col) if stats is None else stats
    out: list[Rung] = []
    for p in ladder:
        why, n = invalid(p), 0
        if why is None:
            n = fit_vocabulary(stats[p.analyzer], n_docs_of(train, id_col), p).count()
            why = None if n else "empty vocabulary"
        out.append(Rung(p, why, n, why is None and not any(r.chosen for r in out)))
    return out
