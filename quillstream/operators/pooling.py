"""Embeddings of texts as weighted means of their word vectors, without the direction that all texts share.

A plain mean is ruled by the words of every text. Here a word counts a / (a + its share of all words), and what is
left of the common ground, the first principal component of the means, is taken out of each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.operators import embed
from quillstream.session import ship_package

# The share of all words at which a word counts half.
RARE = 1e-3


def weighted_vectors(spark: SparkSession, vectors: str, path: str, rare: float = RARE) -> str:
    """Word vectors saved at ``vectors``, each times its weight, saved at ``path``, a new folder. They are word
    vectors of the same kind. A bucket that the fit has not met has no vector, as before."""
    if rare <= 0:
        raise ValueError("rare must be positive")
    model = embed.load_vectors(spark, vectors)
    words = model.table.agg(F.sum("n")).first()[0] or 0
    weight = rare / (rare + F.col("n") / max(words, 1))
    table = model.table.withColumn("vector", F.transform("vector", lambda t: (t * weight).cast("float")))
    table.write.parquet(f"{path}/vectors")
    spark.range(1).select(F.lit(model.size).alias("size"), F.lit(model.buckets).alias("buckets")).write.json(
        f"{path}/parameters"
    )
    return path


def _products(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Place and sum of the outer products of a task's vectors with themselves."""
    total = np.zeros((size, size))
    for batch in batches:
        x = pc.list_flatten(batch.column("embedding")).to_numpy(zero_copy_only=False).astype(np.float64)
        x = x.reshape(-1, size)
        total += x.T @ x
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total.ravel()[met])], ["place", "x"])


def first_component(vectors: DataFrame, size: int) -> list[float]:
    """The direction, of length one, in which the vectors of the column embedding have most of their squared
    length. Its largest number is positive; without a vector that isn't zero, it is zero.

    One aggregate: a task sends size * size sums at most, however many rows it has, and so many come to the
    driver.
    """
    ship_package(vectors.sparkSession)
    rows = vectors.select("embedding").where("embedding IS NOT NULL")
    sums = rows.mapInArrow(lambda batches: _products(batches, size), "place long, x double")
    total = np.zeros(size * size)
    for row in sums.groupBy("place").agg(F.sum("x").alias("x")).collect():
        total[row["place"]] = row["x"]
    if not total.any():
        return [0.0] * size
    total = total.reshape(size, size)
    direction = np.linalg.eigh((total + total.T) / 2)[1][:, -1]
    return (direction * np.sign(direction[np.abs(direction).argmax()])).tolist()


def fit_pooling(rows: DataFrame, vectors: str, path: str, text: str = "text", rare: float = RARE) -> str:
    """Weigh the word vectors saved at ``vectors`` and find the component that the means of all rows share; both
    are saved at ``path``, a new folder. NULL texts and texts without words count for nothing."""
    spark = rows.sparkSession
    weighted_vectors(spark, vectors, path, rare)
    size = embed.load_vectors(spark, path).size
    direction = first_component(embed.mean_vectors(rows.select(text), path, text), size)
    spark.createDataFrame([(direction,)], "direction array<double>").write.parquet(f"{path}/component")
    return path


def pooled_vectors(rows: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds ``embedding``, the weighted mean of the words of a text column without the component that texts share.
    A text without a word (or NULL) gets the zero vector. No shuffle; serves streams."""
    direction = rows.sparkSession.read.parquet(f"{path}/component").first()["direction"]
    return embed.mean_vectors(rows, path, text, direction)
