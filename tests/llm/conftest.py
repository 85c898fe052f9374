import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def frame(spark):
    """Rows (doc_id, text) as a documents table with a column named like an
    operator's own (bucket), in several partitions."""
    def make(rows):
        full = [(i, t, "en" if i is None or i % 2 else None, "s", len(t or ""), 1) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS + ", bucket int").repartition(3)
    return make
