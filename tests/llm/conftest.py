from __future__ import annotations

import pytest

EDGE = [
    (None, "text without an id", "en", "s", 5),
    (7, None, "en", None, None),
    (8, "", None, "s", 0),
    (9, " \n\t ", "en", "s", 4),
    (10, "word " * 40_000, "en", "s", 200_000),
    (11, "repeated row of seven words in all", "en", "s", 1),
    (11, "repeated row of seven words in all", "en", "s", 1),
    (12, "Ein Text mit Umlauten äöü und 😀 am Ende", "de", "s", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def edge(spark):
    """Nulls, empty and very long texts, repeated rows, and columns with names of results."""
    df = spark.createDataFrame(EDGE, SCHEMA)
    return df.selectExpr("*", "1 AS shard", "'x' AS found", "'y' AS score", "2 AS n_words")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
