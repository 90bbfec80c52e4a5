from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names the operators use themselves, as a caller's columns.
CLASHING = ("row", "id", "size", "kept", "shard", "value", "fingerprint", "score", "ids", "n", "Text2")


@pytest.fixture
def documents(spark):
    def make(rows, schema=SCHEMA):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def odd_documents(documents):
    """NULLs in every column, empty, long and repeated rows, ties, and clashing extra columns."""
    pick = random.Random(5)
    words = ["alpha", "Beta", "gamma", "delta", "über", "été", "x", "1234", "日本", "\U0001f642"]
    rows = [
        (None, None, None, None, None),
        (1, "", "en", "a", 0),
        (2, None, "en", None, 0),
        (3, " \t\n ", None, "a", 4),
        (4, "!!! ... 123", "fr", "b", 11),
        (5, "one line that repeats\nsecond", "en", "a", 10),
        (6, " ONE line that repeats \nthird", "en", "a", 10),
        (7, "word " * 40_000 + "x" * 3000, "en", "c", 1),
        (8, "a\x00b\r\nc", "de", "b", 6),
    ]
    rows += [
        (9 + i, " ".join(pick.choices(words, k=pick.randint(1, 60))), "en", f"s{i % 3}", i)
        for i in range(40)
    ]
    rows += [rows[12]] * 3 + [(100, rows[13][1], "en", "s1", 1)]
    df = documents(rows)
    for name in CLASHING:
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df


@pytest.fixture
def no_documents(documents):
    return documents([])
