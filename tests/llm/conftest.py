from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text, lang, source) rows, with a column whose name clashes."""

    def make(rows):
        filled = [(*r, *[None] * (4 - len(r)), len(r[1] or ""), "x") for r in rows]
        return spark.createDataFrame(filled, "doc_id long, text string, lang string, source string, n_chars long, words string")

    return make


@pytest.fixture(scope="session")
def repo() -> Path:
    return Path(__file__).resolve().parents[2]
