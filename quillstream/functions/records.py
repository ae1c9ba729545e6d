"""Records (key and JSON value) and items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.schema import ITEM


def item_key(item_id: Column) -> Column:
    """The record key of an item: its id as text."""
    return item_id.cast("string")


def whole_row_json() -> Column:
    """All columns of the row as one JSON object. NULL fields are left out."""
    return F.to_json(F.struct("*"))


def parse_item(value: Column, schema: T.StructType = ITEM) -> Column:
    """JSON text as an item struct. Text that is not a JSON object gives NULL fields, no error."""
    return F.from_json(value, schema)


CORRUPT = "_corrupt"


def parse_item_strictly(value: Column, schema: T.StructType) -> Column:
    """The same, with the text itself in the field CORRUPT if it isn't JSON or a field isn't of its type."""
    widened = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(value, widened, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def item_fault(value: Column, item: Column) -> Column:
    """What is wrong with a payload that was parsed strictly, NULL if nothing is: ``missing`` (NULL, or the JSON
    null of an id without an item), ``no-object`` (anything that doesn't open one), ``malformed``, ``field-type`` or
    ``no-id``. Only payloads that fail are looked at a second time."""
    bare = F.trim(value, F.lit(" \t\r\n"))
    valid = F.get_json_object(value, "$").isNotNull()
    return (
        F.when(value.isNull() | (bare == "null"), "missing")
        .when(~bare.startswith("{"), "no-object")
        .when(item[CORRUPT].isNotNull(), F.when(valid, "field-type").otherwise("malformed"))
        .when(item["id"].isNull(), "no-id")
    )


def json_text_field(value: Column, field: str) -> Column:
    """One field of a JSON object as text; NULL if it is absent or the text is not JSON."""
    return F.get_json_object(value, f"$['{field}']")


def compact_json(value: Column) -> Column:
    """JSON without layout. Fields no schema knows, the order of keys, repeated keys and numbers stay as
    they are written. Malformed text gives NULL, and so does every payload that is not an object."""
    is_object = F.ltrim(value, F.lit(" \t\r\n")).startswith("{")
    valid = F.get_json_object(value, "$").isNotNull()
    return F.when(is_object & valid, F.regexp_replace(value, r'("(?:[^"\\]|\\.)*+")|\s+', "$1"))


def epoch_timestamp(seconds: Column) -> Column:
    """Epoch seconds as timestamp. The cast saturates where timestamp_seconds would raise, so one
    absurd number cannot stop a stream."""
    return seconds.cast("timestamp")
