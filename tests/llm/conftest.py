from __future__ import annotations

import pytest

PROSE = "the house stood near the river and the people of the village came there in the evening to talk about rain and harvest while children ran along the old wall until night fell over the fields"
LONG = " ".join(f"word{i % 977} said{i % 13}." for i in range(40_000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, bits long, id string, "
    "ids string, size string, shard string, key string, words string, stratum string, `end` int, predicted string"
)


def document(doc_id, text, lang="en"):
    n = len(text) if text is not None else None
    return (doc_id, text, lang, "s", n, -1.0, 7, "x", "x", "x", "x", "x", "x", "x", 3, "x")


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, very long, repeated and tied texts, null ids and languages, clashing columns."""
    rows = [
        document(1, None),
        document(2, ""),
        document(3, " \t\n "),
        document(4, PROSE),
        document(4, PROSE),
        document(5, PROSE),
        document(6, LONG, None),
        document(None, PROSE + " again"),
        document(None, None, None),
        document(7, "a b"),
        document(8, "  été 漢字 😀 \x1c Σ <|endoftext|>"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
