import pytest
from pyspark.sql import functions as F

LONG = "alpha beta gamma delta " * 6000
AWKWARD = [
    (1, "The first text is plain, and it has a few words.", "en", "a"),
    (1, "The first text is plain, and it has a few words.", "en", "a"),  # a repeated row
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n ", "de", "b"),
    (5, LONG, "en", "b"),
    (None, "A text without a key, but with some words in it.", "fr", None),
    (None, None, None, None),
    (6, "1234 5678 !!", "es", "b"),
    (7, "word", "en", "c"),
    (8, "The first text is plain, and it has a few words.", "en", "c"),
    (2**53 + 1, "x" * 5000, "en", "c"),
    (9, "'s 't don't  stop\n\n\tnow 42 日本語 😀 é", "en", "c"),
]
CLASHING = ("score", "kept", "size", "shard", "n_words", "__text", "__id", "label", "votes", "fingerprint", "ids")


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty, blank and long texts, repeated rows, ties, and columns with names that operators use themselves."""
    docs = spark.createDataFrame(AWKWARD, "doc_id bigint, text string, lang string, source string")
    return docs.withColumns({c: F.lit("other") for c in CLASHING if not c.startswith("__")}).withColumns(
        {c: F.lit(None).cast("string") for c in CLASHING if c.startswith("__")})


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
