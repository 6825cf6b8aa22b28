from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    def build(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)

    return build
