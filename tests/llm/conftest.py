"""Small tables with the awkward rows that every operator has to take."""

import pytest

SF = "/root/testdata/sf0.001"

AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, "one", "en", None, 3),
    (5, "one", "en", "a", 3),  # a tie
    (5, "one", "en", "a", 3),  # a repeated row
    (None, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
    (6, "the quick brown fox jumps over the lazy dog " * 3000, "en", "a", 132000),  # very long
    (7, "x" * 30000, None, "a", 30000),
    (8, "É ß 中文 😀 \x00 \x01 <|endoftext|>", "fr", "a", 20),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and long texts, ties and repeats, and columns that clash with names used inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(AWKWARD, schema).repartition(3)
    names = ("row", "base", "signature", "score", "piece", "body", "length", "label", "id", "_row", "_text", "rank")
    for name in names:
        docs = docs.selectExpr("*", f"'clash' as `{name}`")
    return docs


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
