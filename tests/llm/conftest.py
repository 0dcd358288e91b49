from __future__ import annotations

import pytest

LONG = "ab cde\tfgh, IJK\n" * 4_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing column names."""
    rows = [
        (1, "One two three four.", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "a"),
        (None, "one TWO three four.", "en", None),
        (4, "one TWO three four.", None, "b"),
        (4, "one TWO three four.", None, "b"),
        (5, " \t\n ", "xx", "a"),
        (6, LONG, "en", "a"),
        (7, LONG + "x", "en", "a"),
        (8, "Ünï 漢字 \U0001f600 İstanbul ΣΑΣ don't it's 'll 3.5kg Á b c <|endoftext|>", "en", "a"),
        (9, "word", "en", "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("n_chars", "part", "at", "fp", "ids", "key", "n", "first", "base", "spans", "item_id", "score", "toxic", "features", "row", "w"):
        docs = docs.selectExpr("*", f"cast(1 as long) as {name}")
    return docs


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
