from __future__ import annotations

import pytest
from compare import connect

LONG = "lorem ipsum dolor " * 4000


@pytest.fixture(scope="session")
def duck(small):
    return connect(small)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and long texts, repeated rows, and columns whose names operators use inside."""
    line = "shared footer line"
    rows = [
        (1, "one two three four\n" + line, "en", "a", 5),
        (1, "one two three four\n" + line, "en", "a", 5),
        (2, "", "en", "a", 0),
        (3, None, None, None, None),
        (None, "no id here\n" + line, "en", None, 1),
        (4, " \t\n ", "en", "b", 4),
        (5, LONG, "en", "a", len(LONG)),
        (6, "Same Same same " * 30, "de", "b", 1),
        (7, "same same SAME " * 30, "de", "b", 1),
        *[(10 + i, f"text number {i} is not like the others at all {i * i}\n" + line, "en", "a", 9) for i in range(12)],
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *[f"1 as {c}" for c in ("row", "size", "copies", "kept", "stats", "fp", "root", "nth", "host", "lines")])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
