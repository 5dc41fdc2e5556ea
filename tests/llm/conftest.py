from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty and long texts, ties, repeated rows and
    extra columns whose names operators might use themselves."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma\n", "delta.", "élan", "日本", "x", "of", "the", "End"]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    long = text(60_000)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, "   \n\t ", "en", "a", 6),
        (4, "one", "en", "a", 3),
        (5, text(40), "en", "b", None),
        (5, text(41), "en", "b", 7),
        (6, long, "de", "b", len(long)),
        (7, long, "de", "c", len(long)),
        (8, text(300), "fr", None, 1),
        (8, text(2), None, "c", 1),
        (None, text(30), "en", "c", 2),
        (None, None, None, None, None),
        (-9, "a@b.co or 10.0.0.1, call +1 (415) 555-0100", "en", "a", 40),
        (2**62, "naïve café 😀 " * 20, "fr", "b", 9),
    ]
    rows += [(10, "same text in every copy of it", "en", "a", 29)] * 5
    rows += [(20 + k, "near copy of a longer text " * 30 + str(k % 3), "en", "a", 1) for k in range(8)]
    rows = [(*r, k, k, "k", k, 0.5, k) for k, r in enumerate(rows)]
    extra = ", key long, row_key long, g string, size long, fp double, bucket long"
    return spark.createDataFrame(rows, SCHEMA + extra)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
