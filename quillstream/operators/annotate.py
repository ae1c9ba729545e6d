"""Annotation columns and their flat, one-row-per-annotation forms."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions import text as X
from quillstream.functions.keywords import keywords
from quillstream.functions.stopwords import ENGLISH
from quillstream.operators.rows import each


def with_document(items: DataFrame) -> DataFrame:
    return items.withColumn("document", X.document("text"))


def with_sentences(items: DataFrame) -> DataFrame:
    return items.withColumn("sentence", X.sentences("document"))


def with_tokens(items: DataFrame, units: str = "sentence") -> DataFrame:
    """Tokens of the sentences or, with ``units="document"``, of the whole text."""
    return items.withColumn("token", X.tokens(units))


def with_keywords(items: DataFrame, **options) -> DataFrame:
    """Keywords from the token column; options as in ``functions.keywords.keywords``."""
    return items.withColumn("keywords", keywords("token", **options))


def with_whitespace_tokens(items: DataFrame) -> DataFrame:
    """Lower-cased text split at every single whitespace character."""
    return Tokenizer(inputCol="text", outputCol="tokens").transform(items)


def with_word_count(items: DataFrame) -> DataFrame:
    """Number of tokens in the token column, punctuation counted."""
    return items.withColumn("wordCount", F.size("token"))


def without_stop_words(items: DataFrame) -> DataFrame:
    """The whitespace tokens that are no English stop words."""
    remover = StopWordsRemover(inputCol="tokens", outputCol="filtered_token", stopWords=ENGLISH)
    return remover.transform(items)


def annotation_rows(items: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per annotation of a column: the kept columns, position, and the annotation's fields."""
    return each(items, column, "ann", *keep).select(*keep, "position", "ann.*")
