from __future__ import annotations

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with the given tables' other columns and two that clash."""

    def make(*pairs, extra=("sequence_id", "fp")):
        rows = [(i, t, "en", "s", len(t or ""), *[None] * len(extra)) for i, t in pairs]
        return spark.createDataFrame(rows, DOC + "".join(f", {c} string" for c in extra))

    return make
