from __future__ import annotations

import pytest

from quayside.llm.store import prepare


@pytest.fixture(scope="session")
def sp(spark):
    prepare(spark)
    return spark


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(sp):
    """A frame of documents from (doc_id, text) pairs; the other columns may be null."""

    def make(*pairs):
        return sp.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in pairs], DOCS)

    return make
