from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a documents table from (doc_id, text) or full rows."""

    def make(*rows):
        full = [r if len(r) == 5 else (r[0], r[1], "en", "s1", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
