"""Text expressions: clean-up, tokens, n-grams and text statistics.

Every function returns a ``Column`` built from Spark's built-in functions and
higher-order functions, so the work stays in the JVM (but for accents).  Each
one has a DuckDB twin in ``plans/sqlfrag.py`` that the correctness check runs.
"""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whitespace as Python's ``str.split()`` / ``re`` ``\s`` see it (ASCII space
# class, Unicode separators, the four information separators and NEL).
WS = r"[\s\p{Z}\x{1C}-\x{1F}\x{85}]"

# Fixed values (must equal the reference): whole-word unit rewrites, applied in
# this order after lowercasing.  "okgs" is the reference's own pattern; "kgs" is
# our addition so that the intended rewrite happens too.
UNIT_REWRITES = [
    ("lbs", "lb"),
    ("ounces", "oz"),
    ("okgs", "kg"),
    ("kilograms", "kg"),
    ("grams", "g"),
    ("liters", "l"),
    ("milliliters", "ml"),
    ("kgs", "kg"),
]

# Token rule of the default word vectoriser: runs of two or more letters,
# digits or underscores.
WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_empty(c: str | Column) -> Column:
    return F.coalesce(col_of(c).cast("string"), F.lit(""))


def normalize(c: str | Column) -> Column:
    """null → "", lowercase, whitespace runs → one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(fill_empty(c)), WS + "+", " "))


def unit_normalize(c: str | Column) -> Column:
    out = col_of(c)
    for pat, rep in UNIT_REWRITES:
        out = F.regexp_replace(out, rf"\b{pat}\b", rep)
    return out


def preprocess(c: str | Column) -> Column:
    """The text pipeline's clean-up: lowercase, unit rewrite, collapse spaces."""
    lowered = F.lower(fill_empty(c))
    return F.trim(F.regexp_replace(unit_normalize(lowered), WS + "+", " "))


class _Folds(dict):
    """Characters and what is left of their decomposition without combining marks."""

    def __missing__(self, c: int) -> str:
        out = self[c] = "".join(d for d in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(d))
        return out


_FOLDS = _Folds()


def fold_accents(s: str) -> str:
    """Compatibility decomposition without its combining marks, any script.  Only
    marks are ever reordered, so characters are folded one by one."""
    return s if s.isascii() else s.translate(_FOLDS)


@functools.lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(from, to) strings for DuckDB's ``translate``: every Latin letter whose
    folded form is a single character.  Generated from the Unicode database."""
    src, dst = [], []
    for cp in list(range(0x00C0, 0x0250)) + list(range(0x1E00, 0x1F00)):
        ch = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if len(base) == 1 and base != ch:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def strip_accents(c: str | Column) -> Column:
    """Accents folded (``fold_accents``).  Spark has no normalization function, so
    texts that are not ASCII go through an Arrow-batched UDF; others do not."""
    x = col_of(c)
    ascii_only = F.octet_length(x) == F.char_length(x)

    @F.pandas_udf(T.StringType())
    def fold(s: pd.Series) -> pd.Series:
        return s.map(fold_accents, na_action="ignore")

    return F.when(ascii_only, x).otherwise(fold(F.when(~ascii_only, x)))


def analyzer_text(c: str | Column, accents: bool = True) -> Column:
    """What the vectoriser sees: null → "", lowercase, accents stripped."""
    low = F.lower(fill_empty(c))
    return strip_accents(low) if accents else low


def word_tokens(c: str | Column) -> Column:
    return F.regexp_extract_all(col_of(c), F.lit(WORD_TOKEN), 0)


# The English list that Spark ML's StopWordsRemover loads by default,
# in its order (tests compare the two).
STOP_WORDS_ENGLISH = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while
of at by for with about against between into through during before after above below to from up down in out
on off over under again further then once here there when where why how all any both each few more most
other some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll
she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's
who's why's would
""".split())


def spark_stop_words() -> tuple[str, ...]:
    return STOP_WORDS_ENGLISH


def remove_stop_words(tokens: Column, stop_words: tuple[str, ...] | None = None) -> Column:
    words = list(stop_words if stop_words is not None else spark_stop_words())
    # a literal IN list becomes a hash-set lookup (InSet) after optimisation
    return F.filter(tokens, lambda t: ~t.isin(*words))


def word_ngrams(tokens: Column, n_max: int = 2) -> Column:
    """Unigrams followed by adjacent n-grams up to ``n_max`` joined by a space.

    Built with ``zip_with`` over shifted slices so the token array is computed
    once per row; a lambda that indexes into the token *expression* would
    re-evaluate the tokenizer for every position.
    """
    out = tokens
    grams = tokens
    for n in range(2, n_max + 1):
        shifted = F.slice(tokens, n, F.greatest(F.size(tokens), F.lit(1)))
        # zip_with pads the shorter side with null; concat with null is null
        grams = F.zip_with(grams, shifted, lambda a, b: F.concat(a, F.lit(" "), b))
        out = F.concat(out, F.filter(grams, lambda g: g.isNotNull()))
    return out


def char_wb_ngrams(c: str | Column, n_min: int = 3, n_max: int = 4) -> Column:
    """Character n-grams inside word boundaries.

    Each whitespace-separated word is padded with one space on both sides.  For
    every n the padded word yields all its length-n substrings when it is at
    least n long; a padded word shorter than ``n_min`` yields itself once.
    """
    empty = F.array().cast("array<string>")

    def grams(word: Column) -> Column:
        w = F.concat(F.lit(" "), word, F.lit(" "))
        L = F.length(w)
        parts = []
        for n in range(n_min, n_max + 1):
            all_n = F.transform(F.sequence(F.lit(1), L - n + 1), lambda i: F.substring(w, i, n))
            if n == n_min:
                parts.append(F.when(L >= n, all_n).otherwise(F.array(w)))
            else:
                parts.append(F.when(L >= n, all_n).otherwise(empty))
        return F.concat(*parts)

    words = F.filter(F.split(col_of(c), WS + "+"), lambda x: x != "")
    return F.flatten(F.transform(words, grams))


# ---- text statistics (row 21-25) -------------------------------------------------

def char_count(c: str | Column) -> Column:
    return F.length(fill_empty(c))


def word_count(c: str | Column) -> Column:
    return F.size(F.filter(F.split(fill_empty(c), WS + "+"), lambda x: x != ""))


def _ratio(num: Column, c: Column) -> Column:
    n = F.length(c)
    return F.when(n == 0, F.lit(0.0)).otherwise(num.cast("double") / n)


@F.pandas_udf(T.LongType())
def distinct_chars(texts: pd.Series) -> pd.Series:
    """Distinct characters of each text; what is held is bounded by the alphabet
    (a JVM expression would need an array of all characters of a text)."""
    return pd.Series([len(set(t)) if t else 0 for t in texts], dtype="int64")


def unique_char_ratio(c: str | Column) -> Column:
    t = fill_empty(c)
    return _ratio(distinct_chars(t), t)


def punct_ratio(c: str | Column) -> Column:
    """Characters that are not letters or digits (spaces count) ÷ length."""
    t = fill_empty(c)
    return _ratio(F.length(F.regexp_replace(t, r"[\p{L}\p{N}]", "")), t)


def digit_ratio(c: str | Column) -> Column:
    t = fill_empty(c)
    return _ratio(F.length(t) - F.length(F.regexp_replace(t, r"\p{Nd}", "")), t)


def sentence_count(c: str | Column) -> Column:
    """Non-blank pieces between runs of ``.``, ``!`` or ``?``."""
    return F.size(F.filter(F.split(fill_empty(c), r"[.!?]+"), lambda x: F.trim(x) != ""))


TEXT_STATS = ("char_count", "word_count", "unique_char_ratio", "punct_ratio", "digit_ratio")


def text_stats(c: str | Column) -> list[Column]:
    return [
        char_count(c).cast("double").alias("char_count"),
        word_count(c).cast("double").alias("word_count"),
        unique_char_ratio(c).alias("unique_char_ratio"),
        punct_ratio(c).alias("punct_ratio"),
        digit_ratio(c).alias("digit_ratio"),
    ]
