import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents of (id, text) pairs, with columns whose names clash with those of operators."""

    def make(pairs, langs=None):
        rows = [(i, t, (langs or {}).get(i), "s", None if t is None else len(t), 1, "x", 2.0) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS + ", n_words int, words string, score double")

    return make
