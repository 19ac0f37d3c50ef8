import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
LONG = "the quick brown fox jumps over the lazy dog and runs away " * 3000
ODD_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog.\nA second line of the text, with some more words.", "en", "a", 10),
    (2, "", "en", "a", 0),
    (3, None, None, None, None),
    (4, "The quick brown fox jumps over the lazy dog.\nA second line of the text, with some more words.", "en", "b", 10),
    (4, "The quick brown fox jumps over the lazy dog.\nA second line of the text, with some more words.", "en", "b", 10),
    (5, LONG, "en", "a", len(LONG)),
    (6, LONG + "and now rests", "en", "a", len(LONG) + 13),
    (7, "été 日本 😀 ▁ \x00 \t\r\n  *** 123", "fr", None, 5),
    (8, " ", None, "c", 1),
    (9, "x", "de", "c", 1),
    (None, "A row without an id has a text, too.", "en", "c", 1),
    (None, None, "en", "c", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, odd characters."""
    return spark.createDataFrame(ODD_ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def clashing(odd):
    """Columns with the names that operators use for themselves."""
    from pyspark.sql import functions as F

    names = "print component_id spans rank salt ids n score predicted held_out span_ id kind root node a b k bits value"
    return odd.select("*", *[F.lit("own").alias(name) for name in names.split()])
