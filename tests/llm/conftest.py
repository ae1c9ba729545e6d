import pytest
from pyspark.sql import functions as F


@pytest.fixture
def odd(spark):
    """Nulls in any column, empty and blank texts, repeated rows, ties, columns with clashing names."""
    prose = "the quick brown fox jumps over the lazy dog and runs away. " * 9
    rows = [
        (1, prose, "en", "a"),
        (1, prose, "en", "a"),
        (2, prose, None, "b"),
        (3, "", "en", "a"),
        (4, None, None, None),
        (None, "word", "en", None),
        (None, "word", "en", None),
        (5, " \n\t ", "de", "b"),
        (6, "Σίσυφος İ é it's 42% <|endoftext|> naïve 日本", "de", "b"),
        (7, "x" * 200_000, "en", "a"),
        (8, prose.replace("lazy", "idle", 1), "en", "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("rid", "id", "row", "value", "kept", "size", "n", "copies", "features", "label"):
        docs = docs.withColumn(name, F.lit(name))
    return docs


@pytest.fixture
def none(odd):
    return odd.limit(0)
