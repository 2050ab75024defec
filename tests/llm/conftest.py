from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture()
def documents(spark):
    """Rows (doc_id, text, source) with columns whose names the operators use inside."""

    def make(rows):
        full = [(*r, "de", 7, "x", 1, 2) if len(r) == 3 else (*r, "src", "de", 7, "x", 1, 2) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, source string, lang string, n_chars long, row string, size long, node long")

    return make


ODD = [(1, None, None), (2, "", "a"), (3, "   ", "a"), (4, "one", None), (5, "word " * 30000, "b"), (6, "same text here", "a"), (6, "same text here", "a"), (None, "no id at all", "b")]
