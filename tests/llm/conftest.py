from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_id string, body string, digest string, place string, keep_id string"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows; keys repeat only with equal texts."""
    long_text = " ".join("w{}".format(i % 977) for i in range(30_000))
    return [
        (1, "the quick brown fox jumps over the lazy dog again", "en", "a", 1),
        (2, "the  quick\tbrown fox\njumps over the lazy dog again", "en", "a", 1),
        (3, "THE quick brown fox jumps over the lazy dog again", "en", None, 1),
        (4, None, None, "b", None),
        (5, "", "de", "", 0),
        (6, "   \t\n", None, None, 0),
        (7, long_text, "en", "b", 1),
        (8, long_text + " end", "en", "b", 1),
        (9, "one", "fr", "c", 1),
        (9, "one", "fr", "c", 1),
        (10, "one", "fr", "c", 1),
        (None, "one", "fr", "c", 1),
        (None, "alone without a key", None, None, None),
        (11, "été ÉTÉ ß ñ 日本語 \U0001f600 \U0001f600", "fr", "c", 1),
        (12, "a b c", "en", "a", 1),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", "y", "z", "p", "q") for r in odd_rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

