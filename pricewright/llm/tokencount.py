"""Exact token counts with the public tokenizers.

A huge text is encoded in overlapping chunks with offsets.  Two neighbours are
spliced at a *proven stable* boundary inside their overlap: a white-space
character, for a tokenizer whose own rules drop white space before anything is
merged, so that no token depends on both sides of it.  The tokens that both
chunks give for the words between the first and the last such place of the
overlap must agree; if there is no such place, or they differ, the overlap is
widened, and in the end the chunk itself grows.

Ordinary texts of such a tokenizer are counted by the same proof: pieces between
white space are encoded once and remembered (a bounded cache).  Other tokenizers
get whole texts.

Edge cases: null counts as empty (0 bytes, 0 tokens); special strings inside a
text are handled as the library does by default; no begin, end or added tokens,
no truncation or padding.  Every row is counted by itself: repeated rows and equal
ids repeat their counts, an empty table gives an empty result, and a further
column named ``__n_tokens`` is replaced.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filled, tokenizer_path, with_columns_of

CHUNK = 1 << 15
OVERLAP = 512
#: Pieces that a task remembers before it lets go of them.
HELD = 300_000
#: White space to every regular expression and normalizer in question.
SPACE = re.compile(r"[ \t\n\r\x0b\x0c]")


def drops_white_space(spec: dict) -> bool:
    """Whether white space separates all that the tokenizer does: characters are
    normalized one by one (or composed, which white space stops), and words are
    the matches of a pattern without white space, all else being removed."""
    def steps(part, name):
        return [] if part is None else [x for p in part[name] for x in steps(p, name)] if name in part else [part]

    norm, pre = steps(spec.get("normalizer"), "normalizers"), steps(spec.get("pre_tokenizer"), "pretokenizers")
    replaced = [n for n in norm if n["type"] == "Replace"]
    if any(n["type"] not in ("NFC", "Lowercase", "Replace") for n in norm) or any(
            n["pattern"] != {"Regex": r"\s+"} or n["content"] != " " for n in replaced):
        return False
    if not pre or pre[0]["type"] != "Split" or pre[0]["behavior"] != "Removed" or not pre[0]["invert"]:
        return False
    pattern = pre[0]["pattern"].get("Regex", "")
    open_ended = re.sub(r"\[\^\\s[^\]]*\]|\[\\p\{[LN]\}\]\+?|'\w+|\|", "", pattern).strip("+")
    rest = all(p["type"] == "ByteLevel" and not p["add_prefix_space"] for p in pre[1:])
    return open_ended == "" and rest and spec["model"]["type"] == "BPE" and not any(
        t["lstrip"] or t["rstrip"] or SPACE.search(t["content"]) for t in spec.get("added_tokens", []))


class Encoder:
    """One tokenizer in a task."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.chunk, self.overlap, self.pieces = chunk, overlap, {}
        if path.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=path)
            self.many = lambda texts: [len(x) for x in processor.encode(texts, num_threads=1)]
            self.separable = False
        else:
            import tokenizers

            with open(path, encoding="utf-8") as f:
                self.separable = drops_white_space(json.load(f))
            self.lib = tokenizers.Tokenizer.from_file(path)
            self.lib.no_truncation()
            self.lib.no_padding()
            self.many = lambda texts: [len(e) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def offsets(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, id) of each token, in characters."""
        e = self.lib.encode(text, add_special_tokens=False)
        return [(a, b, i) for (a, b), i in zip(e.offsets, e.ids)]

    def count(self, texts: list[str]) -> list[int]:
        if not self.separable:
            return [n for t in texts for n in self.many([t])]
        return [self.spliced(t) if len(t) > self.chunk else self.by_pieces(t) for t in texts]

    def by_pieces(self, text: str) -> int:
        words = text.encode("utf-8").split()  # bytes: ASCII white space only
        known = self.pieces
        new = list({w for w in words if w not in known})
        if new:
            if len(known) > HELD:
                known.clear()
                new = list(set(words))
            known.update(zip(new, self.many([w.decode("utf-8") for w in new])))
        return sum(map(known.__getitem__, words))

    def spliced(self, text: str) -> int:
        """Tokens of a huge text, one pair of overlapping chunks at a time."""
        n, at, size, total = len(text), 0, self.chunk, 0
        left = self.offsets(text[:size])
        while at + size < n:  # left holds the tokens of text[at:at + size]
            end, width = at + size, self.overlap
            while True:
                start = max(at, end - width)
                right = self.offsets(text[start:start + self.chunk]) if start > at else []
                cut = self.boundary(text, left, at, right, start, end) if start > at else None
                if cut is not None or start == at:
                    break
                width *= 2
            if cut is None:  # nowhere to splice: the chunk grows
                size *= 2
                left = self.offsets(text[at:at + size])
                continue
            total += sum(a + at < cut for a, _, _ in left)
            left = [(a + start - cut, b + start - cut, i) for a, b, i in right if a + start >= cut]
            at, size = cut, start + self.chunk - cut
        return total + len(left)

    @staticmethod
    def boundary(text: str, left, at: int, right, start: int, end: int) -> int | None:
        """The last stable place of the overlap text[start:end], if both sides
        agree on all tokens between the first and the last of them."""
        places = [m.start() for m in SPACE.finditer(text, start, end)]
        if len(places) < 2:
            return None
        first, last = places[0], places[-1]
        mine = [(a + at, b + at, i) for a, b, i in left if first <= a + at < last]
        other = [(a + start, b + start, i) for a, b, i in right if first <= a + start < last]
        return last if mine and mine == other else None


def token_counts(docs: DataFrame, tokenizer: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``__n_tokens`` beside the columns of the documents.  ``tokenizer`` is a
    tokenizers ``.json`` or a sentencepiece ``.model`` file: its path, the same on
    every executor, or its name in ``public_tokenizers``, which each executor looks
    up for itself."""
    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        encoder = Encoder(tokenizer_path(tokenizer), chunk, overlap)
        for t in texts:
            yield pd.Series(encoder.count(list(t)), dtype="int64")

    return with_columns_of(docs, __n_tokens=count(filled()))


def token_digest(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """One row a document: bytes, tokens, and whether it exceeds ``limit``."""
    rows = token_counts(docs.select("doc_id", "text"), tokenizer)
    return rows.select("doc_id", F.octet_length(filled()).cast("long").alias("n_bytes"),
                       F.col("__n_tokens").alias("n_tokens"), (F.col("__n_tokens") > limit).alias("over_limit"))
