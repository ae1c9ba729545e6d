"""The test tables as items and records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.functions.records import whole_row_json
from quillstream.schema import ITEM

# Epoch seconds of document 0; each following document is a minute later.
FIRST_EPOCH = 1160418111


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as comments. The columns a comment does not carry are left out, and so are NULL
    once the item has been through JSON."""
    return read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.lit("comment").alias("type"),
        F.col("source").alias("by"),
        (F.lit(FIRST_EPOCH) + 60 * F.col("doc_id")).alias("time"),
        "text",
    )


def to_item_schema(items: DataFrame) -> DataFrame:
    """All item columns, NULL where the input has none."""
    present = set(items.columns)
    return items.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ITEM.fields
        ]
    )


def as_topic(rows: DataFrame, key: str, topic: str = "items") -> DataFrame:
    """Rows as messages of a topic, in the layout of Spark's Kafka source. The key doubles as
    offset."""
    return rows.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        whole_row_json().cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col(key).cast("long").alias("offset"),
        F.timestamp_seconds(F.lit(FIRST_EPOCH)).alias("timestamp"),
    )


def land_topic(rows: DataFrame, key: str, path: str, rows_per_file: int = 5000) -> str:
    """Write a topic as parquet files, the offline stand-in for a broker: as many files as the rows
    need, without a shuffle."""
    as_topic(rows, key).write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return path
