"""Schemas of the data that flows through the package."""

from __future__ import annotations

from pyspark.sql import types as T

# One forum item. Ids and epochs are 64 bit, so an id above 2^31 does not parse to NULL.
ITEM = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("deleted", T.BooleanType()),
        T.StructField("type", T.StringType()),
        T.StructField("by", T.StringType()),
        T.StructField("time", T.LongType()),
        T.StructField("dead", T.BooleanType()),
        T.StructField("kids", T.ArrayType(T.LongType())),
        T.StructField("text", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("descendants", T.IntegerType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("parent", T.LongType()),
        T.StructField("parts", T.ArrayType(T.LongType())),
    ]
)

# A message of a topic, with the column names and types of Spark's Kafka source.
RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# One annotation. Annotation columns are arrays of these; begin and end are inclusive
# character offsets into the text of the item.
ANNOTATION = T.StructType(
    [
        T.StructField("annotatorType", T.StringType()),
        T.StructField("begin", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("result", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("embeddings", T.ArrayType(T.FloatType())),
    ]
)

ANNOTATIONS = T.ArrayType(ANNOTATION)
