from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) pairs, with columns whose names the operators use inside."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or ""), "x", 1) for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, q_ string, fp int"
        )

    return make


ODD = [(1, None), (2, ""), (3, "   \n "), (None, "word " * 30), (4, "word " * 30), (4, "word " * 30), (5, "é" * 3000)]


@pytest.fixture
def odd():
    return ODD
