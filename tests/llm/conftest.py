from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, hits string"


@pytest.fixture()
def make(spark):
    """Documents out of (doc_id, text[, source[, lang]]), with further columns whose names the operators use too."""

    def rows(*given):
        full = []
        for g in given:
            doc_id, text, source, lang = (*g, *(None, None)[len(g) - 2 :])[:4] if len(g) < 4 else g
            full.append((doc_id, text, lang, source, len(text or ""), "k", "s", "h"))
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return rows
