from __future__ import annotations

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, k string, id string, size long, label int, Text string, __h long, n_words long"


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    base = " ".join(f"word{i % 97} and{i % 13}" for i in range(120))
    long_text = " ".join(f"w{i * 7919 % 5003}" for i in range(60_000))
    rows = [
        (1, base, "en", "a", len(base)),
        (2, base, "en", "a", len(base)),
        (2, base, "en", "a", len(base)),
        (3, base + " tail", "en", None, None),
        (4, "", "en", "b", 0),
        (5, None, None, None, None),
        (None, base.replace("word5 ", "other "), None, "b", 3),
        (None, None, None, None, None),
        (6, "  \n\t ", "de", "c", 5),
        (7, long_text, "fr", "c", len(long_text)),
        (8, "one two three", "es", "\u00e9", 13),
        (9, "one two three", "es", "\U0001f600", 13),
        (-1, 'password = "hunter22" AKIA' + "Z" * 16 + " " + "0f" * 14, "en", "a", 60),
    ]
    return [(*r, "x", "y", 7, 1, "z", 9, 3) for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    frame = spark.createDataFrame(odd_rows(), COLUMNS)
    spark.conf.unset("spark.sql.caseSensitive")
    return frame


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(-1, 10)] + [(None, 1, 1), (3, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
