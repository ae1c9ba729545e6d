"""Records to items and back: decode, parse, expand, fill, cast, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.functions import records as R
from quillstream.schema import ITEM

FILLED = ["text", "title", "url", "by", "type"]


def decode_records(records: DataFrame) -> DataFrame:
    """Binary key and value as text; other record columns are dropped."""
    return records.select(F.col("key").cast("string"), F.col("value").cast("string"))


def parse_items(records: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Item columns of every record, with its key. A payload that is no JSON object gives a row of
    NULL fields (a ghost). Name the fields a job needs: Spark narrows the schema of a parse by
    itself only where a single field is used."""
    schema = T.StructType([f for f in ITEM.fields if fields is None or f.name in fields])
    parsed = decode_records(records).select("key", R.parse_item(F.col("value"), schema).alias("data"))
    return parsed.select("key", "data.*")


def check_items(records: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Item columns of every record, with its key, its fault (see ``item_fault``; NULL if none) and, where there
    is one, the payload as raw. Each record gives one row, which is an item or a fault; a field named here
    must be one of the item, id is always there. No shuffle; serves streams."""
    schema = T.StructType([f for f in ITEM.fields if fields is None or f.name in {*fields, "id"}])
    parsed = decode_records(records).withColumn("data", R.parse_item_strictly(F.col("value"), schema))
    fault = R.item_fault(F.col("value"), F.col("data")).alias("fault")
    checked = parsed.select("key", "value", "data", fault)
    sound = F.col("fault").isNull()
    return checked.select(
        "key",
        *[F.when(sound, F.col("data")[f.name]).alias(f.name) for f in schema.fields],
        F.when(~sound, F.col("value")).alias("raw"),
        "fault",
    )


def sound_items(checked: DataFrame) -> DataFrame:
    """The items of checked records."""
    return checked.where("fault IS NULL").drop("raw", "fault")


def faulty_records(checked: DataFrame) -> DataFrame:
    """Key, value and fault of the others."""
    return checked.where("fault IS NOT NULL").select("key", F.col("raw").alias("value"), "fault")


def drop_ghosts(items: DataFrame) -> DataFrame:
    """Without the rows whose payload was no item."""
    return items.where(F.col("id").isNotNull())


def normalize_items(items: DataFrame, text_fill: str = "") -> DataFrame:
    """Fill NULL text columns and scores, and turn epoch seconds into timestamps, in those of the
    columns that are there."""
    filled = items.na.fill(text_fill, [c for c in FILLED if c in items.columns])
    if "score" in items.columns:
        filled = filled.na.fill(0, ["score"])
    if "time" in items.columns:
        filled = filled.withColumn("time", R.epoch_timestamp(F.col("time")))
    return filled


def item_text(items: DataFrame) -> DataFrame:
    """The columns annotation needs. The id stays, so annotations can be joined back."""
    return items.select("id", "text")


def encode_records(items: DataFrame, key: str = "id") -> DataFrame:
    """Key and JSON value of every row, as a record sink takes them."""
    return items.select(R.item_key(F.col(key)).alias("key"), R.whole_row_json().alias("value"))


def json_envelope(rows: DataFrame) -> DataFrame:
    """Every row as one JSON text column, value."""
    return rows.select(R.whole_row_json().alias("value"))


def json_field(records: DataFrame, field: str = "id") -> DataFrame:
    """One field of the JSON value, as text."""
    return decode_records(records).select(
        "key", R.json_text_field(F.col("value"), field).alias(field)
    )


def compact_json(records: DataFrame) -> DataFrame:
    """The JSON value without layout."""
    return decode_records(records).select("key", R.compact_json(F.col("value")).alias("value"))
