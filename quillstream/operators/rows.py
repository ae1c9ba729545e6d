"""One row per array element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each(rows: DataFrame, values: Column | str, name: str, *keep: str) -> DataFrame:
    """The kept columns, the position of every element of an array, and the element.

    For a plain explode Spark infers a filter on the array's size and pushes it below the
    projection that computes the array, which then runs twice. The outer form has no such filter;
    the row it adds for an empty array is dropped right after.
    """
    exploded = rows.select(*keep, F.posexplode_outer(values).alias("position", name))
    return exploded.where(F.col("position").isNotNull())
