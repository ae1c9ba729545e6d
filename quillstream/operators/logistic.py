"""Logistic regression on embeddings by Newton's method (iteratively reweighted least squares), and calibration
of its probabilities by pooling adjacent violators.

A round is one aggregate: every task adds up the gradient and the outer products of its rows, and sends as many
numbers as the square of a vector's size, however many rows it has. The driver solves that system.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.operators import classify
from quillstream.session import scratch_path, ship_package

# Times the number of labelled rows: what keeps weights finite where classes can be told apart without error.
RIDGE = 1e-4
MOST_ROUNDS = 50
# The largest change of a weight at which the rounds end.
TOLERANCE = 1e-9
# Probabilities are calibrated by bins of this many equal widths.
BINS = 1024


def training_rows(vectors: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """embedding, label, weight: repeated labels of an item are one weighted row; labels other than 0 and 1 and
    items without a vector are left out."""
    weighted = (
        labels.where("label IN (0, 1)")
        .groupBy(key, F.col("label").cast("double").alias("label"))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    return vectors.select(key, "embedding").where("embedding IS NOT NULL").join(weighted, key).select("embedding", "label", "weight")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, a one in front of each."""
    values = pc.list_flatten(batch.column("embedding")).to_numpy(zero_copy_only=False).astype(np.float64)
    return np.hstack([np.ones((batch.num_rows, 1)), values.reshape(batch.num_rows, -1)])


def _sums(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row: log-likelihood, gradient and outer products of a task's rows, one after another."""
    size = len(weights)
    total = np.zeros(1 + size + size * size)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch)
        y, weight = (batch.column(c).to_numpy() for c in ("label", "weight"))
        logit = x @ weights
        p = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        total[0] += (weight * (y * logit - np.logaddexp(0, logit))).sum()
        total[1 : 1 + size] += x.T @ (weight * (y - p))
        total[1 + size :] += (x.T @ (x * (weight * p * (1 - p))[:, None])).ravel()
    yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["sums"])


def fit_logistic(
    vectors: DataFrame, labels: DataFrame, path: str, key: str = "id", ridge: float = RIDGE
) -> str:
    """Fit on (key, embedding) rows and (key, label) rows with label 0 or 1, and save the model at ``path``, a new
    folder, in the form that ``classify`` reads. Without labelled rows all weights are 0.

    Rounds end when no weight changes any more; a step that lowers the penalised likelihood is halved, so they
    do. An error is raised if they have not ended after MOST_ROUNDS.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    stored = scratch_path(spark, "labelled-vectors")
    training_rows(vectors, labels, key).write.parquet(stored)
    rows = spark.read.parquet(stored)
    count, width = rows.agg(F.sum("weight"), F.max(F.size("embedding"))).first()
    size = (width or 0) + 1
    # The intercept is not held back.
    penalty = np.full(size, ridge * (count or 0.0))
    penalty[0] = 0.0

    def at(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        sums = rows.mapInArrow(lambda b: _sums(b, weights), "sums array<double>")
        found = sums.select(F.posexplode("sums").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x")).collect()
        total = np.zeros(1 + size + size * size)
        for row in found:
            total[row["place"]] = row["x"]
        gradient = total[1 : 1 + size] - penalty * weights
        curvature = total[1 + size :].reshape(size, size) + np.diag(penalty)
        return total[0] - (penalty * weights**2).sum() / 2, gradient, curvature

    weights = np.zeros(size)
    if count:
        likelihood, gradient, curvature = at(weights)
        for _ in range(MOST_ROUNDS):
            step = np.linalg.lstsq(curvature, gradient, rcond=None)[0]
            while True:
                tried = weights + step
                new = at(tried)
                if new[0] >= likelihood - 1e-12 * abs(likelihood) or np.abs(step).max() <= TOLERANCE:
                    break
                step = step / 2
            weights, (likelihood, gradient, curvature) = tried, new
            if np.abs(step).max() <= TOLERANCE * (1 + np.abs(weights).max()):
                break
        else:
            raise ValueError(f"no end after {MOST_ROUNDS} rounds; raise the ridge")
    model = spark.createDataFrame([([float(w) for w in weights[1:]], float(weights[0]))], "coefficients array<double>, intercept double")
    model.write.parquet(path)
    return path


def pooled(scores: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to the scores: adjacent violators are pooled until none is left."""
    level: list[float] = []
    weight: list[float] = []
    length: list[int] = []
    for score, own in zip(scores.tolist(), weights.tolist(), strict=True):
        level.append(score)
        weight.append(own)
        length.append(1)
        while len(level) > 1 and level[-2] >= level[-1]:
            whole = weight[-2] + weight[-1]
            level[-2:] = [(level[-2] * weight[-2] + level[-1] * weight[-1]) / whole]
            weight[-2:] = [whole]
            length[-2:] = [length[-2] + length[-1]]
    return np.repeat(level, length)


def fit_calibration(scored: DataFrame, labels: DataFrame, path: str, key: str = "id", bins: int = BINS) -> str:
    """Learn from (key, positive) and (key, label) rows, which the classifier was not fitted on, what share of
    the items with a probability is positive, and save it at ``path``, a new folder. Rising with the probability;
    an item is added to either class of its bin with half its weight, so that no bin is certain.

    Items are counted by bin before the driver gets them: at most ``bins`` rows.
    """
    weighted = labels.where("label IN (0, 1)").groupBy(key, "label").agg(F.count(F.lit(1)).alias("weight"))
    counts = (
        scored.select(key, _bin(F.col("positive"), bins).alias("bin"))
        .join(weighted, key)
        .groupBy("bin")
        .agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("positive"))
        .orderBy("bin")
        .collect()
    )
    places = np.array([r["bin"] for r in counts], dtype=np.int64)
    n = np.array([float(r["n"]) for r in counts])
    share = (np.array([float(r["positive"]) for r in counts]) + 0.5) / (n + 1)
    levels = (np.arange(bins) + 0.5) / bins
    if len(places):
        # A bin without items has the level of the nearest one below it, the first ones that of the first.
        at = np.maximum(np.searchsorted(places, np.arange(bins), side="right") - 1, 0)
        levels = pooled(share, n)[at]
    table = scored.sparkSession.createDataFrame([([float(x) for x in levels],)], "levels array<double>")
    table.write.parquet(path)
    return path


def _bin(positive: Column, bins: int) -> Column:
    return F.least(F.floor(positive * bins), F.lit(bins - 1)).cast("int")


def calibrated(positive: Column, spark: SparkSession, path: str) -> Column:
    """The share of positive items that a probability stands for."""
    levels = spark.read.parquet(path).first()["levels"]
    table = F.array(*[F.lit(x) for x in levels])
    return F.element_at(table, _bin(positive, len(levels)) + 1)


def classify_calibrated(
    rows: DataFrame, path: str, calibration: str, threshold: float = classify.DEFAULT_THRESHOLD
) -> DataFrame:
    """Adds ``positive`` (calibrated) and ``sentiment`` to rows with an embedding."""
    spark = rows.sparkSession
    raw = F.expr(classify.positive_of(spark, path, "embedding"))
    return rows.withColumn("positive", calibrated(raw, spark, calibration)).withColumn(
        "sentiment", F.expr(classify.label_of("positive", threshold))
    )
