import pytest
from pyspark.sql import types as T

LONG = "lorem ipsum dolor " * 9000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, repeated rows, clashing extra columns."""
    rows = [
        (1, "The cat sat on the mat and looked at the dog", "en", "a", 44, 0.5, "x"),
        (1, "The cat sat on the mat and looked at the dog", "en", "a", 44, 0.5, "x"),
        (2, "Le chat est sur la table et regarde le chien", "fr", None, None, None, None),
        (3, None, "en", "a", None, 1.0, "y"),
        (4, "", None, "a", 0, 1.0, "y"),
        (5, " \t\n 123 !!", "en", "a", 10, 1.0, "y"),
        (None, "the cat and the dog", "en", "a", 19, 1.0, "y"),
        (7, LONG, "en", "a", len(LONG), 1.0, "y"),
        (8, "é à ü ñ <|endoftext|> x", "fr", "a", 5, 1.0, "y"),
    ]
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()), ("score", T.DoubleType()), ("Text", T.StringType())]
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, k) for n, k in fields]))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
