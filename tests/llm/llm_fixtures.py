"""Fixtures of the operator tests."""

import pytest


@pytest.fixture
def ws(spark):
    from barlab.llm.workspace import Workspace

    w = Workspace(spark, "test")
    yield w
    w.clear()


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (doc_id, text, lang, source, n_chars) as a table."""
    def make(rows):
        rows = [r if len(r) == 5 else (*r, "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return make
