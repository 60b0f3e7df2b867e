from __future__ import annotations

import os

import pytest

SMALL = "/root/testdata/sf0.001"

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, h string, fp string, score double"


@pytest.fixture
def docs(spark):
    """A table of documents with extra columns whose names operators use inside."""

    def build(rows):
        """Rows are texts, or ``(doc_id, text)``, or ``(doc_id, text, lang, source)``."""
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            doc_id, text, lang, source = (*row, "en", "s")[:4] if len(row) == 2 else row
            full.append((doc_id, text, lang, source, None if text is None else len(text), "x", "y", 0.5))
        return spark.createDataFrame(full, DOCUMENTS)

    return build


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no driver tables here")
    return SMALL
