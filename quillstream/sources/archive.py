"""Item archives of JSON objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillstream.schema import ITEM


def scan_json_archive(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Items of a directory of JSON files, one compact object per line (or per file). The schema is
    fixed, so no pass over the data infers it."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(ITEM).json(path)


def write_json_archive(items: DataFrame, path: str) -> None:
    """Items as JSON lines, a file per task rather than a file per id."""
    items.write.json(path)
