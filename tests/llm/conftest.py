import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"

@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def real(spark):
    """All documents of the smallest table as (doc_id, text)."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd():
    """Null, empty, blank, repeated, very long and odd texts."""
    long = "word " * 30_000 + "end"
    return [
        (1, None),
        (2, ""),
        (3, " \n\t"),
        (4, "One two three"),
        (4, "One two three"),
        (5, "one TWO three"),
        (None, "no id at all"),
        (None, None),
        (6, long),
        (7, long),
        (8, "é ü\x1fa b  ẞ K ſ"),
        (9, "only"),
        (10, "\\ <s> [INST] 日本語 😀 " * 20),
    ]
