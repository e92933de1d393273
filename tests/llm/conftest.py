from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, fp string"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text[, lang]) rows, with columns whose names the operators also use."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), 0.5, "own", "own") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "without an id"), (None, None),
       (5, "x" * 50_000), (6, "word " * 20_000), (7, "\U0001f600 é 世界 " * 50), (8, "one")]


@pytest.fixture(scope="session")
def odd(docs):
    """Nulls, empty and very long texts, repeated rows and rows without an id."""
    return docs(ODD)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs([])
