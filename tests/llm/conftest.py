from __future__ import annotations

import pytest

LONG = "word and another " * 30_000
# Empty, null, blank, repeated, very long and odd texts; null id and null source.
ODD = [
    (1, "the cat sat on the mat and then it slept", "s1"),
    (2, "the cat sat on the mat and then it slept", "s1"),
    (2, "the cat sat on the mat and then it slept", "s1"),
    (3, "", None),
    (4, None, "s2"),
    (None, "no id here at all", "s2"),
    (5, " \t\n ", "s2"),
    (6, "x", ""),
    (7, LONG, "s1"),
    (8, "naïve  café   don't 12345 \x1c end\r\n\r\n  \U0001f600 ok", "s3"),
]


@pytest.fixture
def odd(spark):
    """Documents with awkward rows and extra columns named like columns of the results."""
    rows = [(i, t, "en", s, 0 if t is None else len(t), 7, 8, "z") for i, t, s in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, size int, score int, _h string"
    )


@pytest.fixture
def no_docs(odd):
    return odd.where("false")


@pytest.fixture
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
