"""Small tables that hold the cases every operator must define."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def edge_rows():
    """Nulls in every column, empty, blank, letterless and long texts, repeated
    rows, one id with two texts, ids at the limits."""
    long_text = " ".join(f"word{k % 977} stone river" for k in range(12_000))
    return [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (1, "another text under the same id", "en", "b", None),
        (None, "no id here but a text", None, None, None),
        (None, None, None, None, None),
        (2, None, "en", "a", None),
        (3, "", "fr", "a", 0),
        (4, "   \n\t ", None, "b", 6),
        (5, "12345 67890 !!! ???", "de", None, 19),
        (6, long_text, "en", "a", len(long_text)),
        (7, "ÉCOLE élève Straße ñandú 東京 😀", "fr", "c", 30),
        (-5, "THE QUICK brown fox jumps over the lazy dog", None, "b", 43),
        (2**62, "x", "es", "c", 1),
    ]


CLASHING = ["size", "shard", "slot", "__key", "__size", "score", "kept", "word", "n_words", "target"]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


@pytest.fixture(scope="session")
def clashing(spark, edge):
    """The same rows with extra columns named like results and helpers."""
    from pyspark.sql import functions as F

    return edge.select("*", *[F.lit("mine").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def bench_items(spark):
    return spark.createDataFrame([(1, "quick brown fox"), (2, "over the lazy"), (2, "over the lazy"), (None, "same id"), (9, None),
                                  (10, "!!")], "item_id long, text string")


@pytest.fixture(scope="session")
def label_rows(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 1), (6, 1, None), (7, None, 1), (None, 1, 1), (99, 0, 0), (1, 0, 0)],
                                 "doc_id long, quality int, toxic int")
