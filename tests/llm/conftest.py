from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_data import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside, as further columns of a table.
CLASHES = ("id", "row", "_row", "key", "fp", "n", "kind", "start", "spans", "piece", "words", "bits", "kept", "score")


@pytest.fixture(scope="session")
def table(spark):
    def make(rows, schema=SCHEMA):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def tricky(spark):
    """NULLs in every column, empty and long texts, repeated rows and ids, and columns with clashing names."""
    from pyspark.sql import functions as F

    text = prose(1, 60)
    rows = [
        (1, text, "en", "a", 10), (1, text, "en", "a", 10), (1, prose(2, 50), "en", "a", 10), (None, text, None, None, None),
        (None, None, None, None, None), (5, "", "en", "a", 0), (6, " \n\t", "fr", "b", 3), (7, "one", "en", "a", 3),
        (8, prose(3, 20_000), "en", "a", 1), (9, "x" * 50_000, "en", "a", 1), (10, "9" * 5_000 + "@" * 5_000, "en", "a", 1),
        (11, text + " more", "en", "a", 1), (12, "naïve Ünïcode 😀 text", "fr", "b", 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.withColumns({name: F.lit("clash") for name in CLASHES})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
