import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; documents may bring them along.
CLASHING = ["n", "key", "label", "band", "sig", "set", "size", "row", "mark", "copies", "bucket", "all", "score",
            "n_grams", "log_weight", "good", "_id", "_n", "ids", "count", "id", "c0"]


@pytest.fixture
def docs(spark):
    """Rows to a documents table with clashing extra columns."""
    def make(rows, extra=True):
        df = spark.createDataFrame(
            [(i, t, "en", s, None if t is None else len(t)) for i, t, s in
             [(*r, "a")[:3] if len(r) == 2 else r for r in rows]], DOCS)
        return df.withColumns({c: F.lit(f"x{c}") for c in CLASHING}) if extra else df
    return make

