"""Token counts equal the library's on whole texts, whatever the chunks."""

import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pricewright.llm.common import tokenizer_path
from pricewright.llm.tokencount import Encoder, drops_white_space, token_digest

PATH = tokenizer_path("word_bpe_49k.json")
PARTS = ["token", "The", "réeux", "ÉCOLE", " ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "\x0b", "'s", "'LL",
         "1234", "ñ", "ñ", "Σ", "ΣΑΣ", "İ", "한국", "한", "<|endoftext|>", "<|startoftext|>", "!!",
         "á̧", "́", "😀", "x" * 40, "ﬁ", "힣", "<|end", "oftext|>"]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def whole(lib, text):
    return len(lib.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("seed", range(6))
def test_pieces_and_splices_equal_the_library(lib, seed):
    rng = random.Random(seed)
    small = Encoder(PATH, chunk=64, overlap=4)
    plain = Encoder(PATH)
    for _ in range(60):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 120)))
        assert plain.by_pieces(text) == whole(lib, text), repr(text)
        assert small.count([text]) == [whole(lib, text)], repr(text)


def test_no_white_space_widens_to_the_whole_text(lib):
    text = "abc" * 500
    assert Encoder(PATH, chunk=32, overlap=4).spliced(text) == whole(lib, text)


def test_only_tokenizers_that_drop_white_space_are_split():
    def says(name):
        with open(tokenizer_path(name), encoding="utf-8") as f:
            return drops_white_space(json.load(f))

    assert says("word_bpe_49k.json") and not says("byte_bpe_50k.json")


def test_sentencepiece_counts_whole_texts():
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    p = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", "The house  is\nred", "x" * 300]
    assert Encoder(path).count(texts) == [len(p.encode(t)) for t in texts]


def test_digest_with_nulls_repeats_and_extra_columns(spark, lib):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (None, None, "y"), (2, "", None), (3, "word " * 3000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, token_digest(df).collect()), key=repr)
    want = sorted([(i, len((t or "").encode()), whole(lib, t or ""), whole(lib, t or "") > 2048) for i, t, _ in rows], key=repr)
    assert got == want
    assert token_digest(df.limit(0)).count() == 0


def test_files_are_found_by_name_or_path(spark):
    assert tokenizer_path("word_bpe_49k.json") == public_tokenizers.path("word_bpe_49k.json") == PATH
    assert tokenizer_path(PATH) == PATH
    df = spark.createDataFrame([(1, "some tokens"), (2, None)], "doc_id long, text string")
    assert token_digest(df).collect() == token_digest(df, PATH).collect()
