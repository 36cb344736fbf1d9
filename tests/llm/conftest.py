from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


LONG = "The quick brown fox jumps over the lazy dog near the old river bank.\n" * 4000

ODD = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 4), (4, "12345 67890", "en", None, 11),
    (5, LONG, "en", "a", len(LONG)), (5, LONG, "en", "a", len(LONG)), (6, LONG, "en", "b", len(LONG)),
    (None, "no id here but quite some words to read", "en", "b", 40), (None, None, None, None, None),
    (7, "one line only", "en", "c", 13), (8, "x" * 50_000, None, "c", 50_000), (9, "日本語 と emoji 😀 ▁ mixed ꙮ", "ja", "c", 20),
]


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()
