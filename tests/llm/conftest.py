"""A table with everything that may go wrong, and ways to make small tables."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, n_lines string, component_id string, sequence_id string"
PROSE = "The quick brown fox jumps over the lazy dog near the quiet river bank at dawn. "


def doc_rows():
    rows = [
        (1, PROSE * 3),
        (1, PROSE * 3),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, "word " * 40_000),
        (6, PROSE.upper()),
        (7, "naïve café ÉCOLE übung 中文 текст 🙂\u0085 <|endoftext|>"),
        (None, PROSE * 3),
        (None, None),
    ]
    return [(i, t, None, "s", None, "x", "x", "x", "x") for i, t in rows]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(doc_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
