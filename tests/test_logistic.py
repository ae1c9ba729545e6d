"""Logistic regression and its calibration against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstream.operators import classify, embed, logistic
from quillstream.session import scratch_path
from quillstream.sources import tables


def rows_of(spark, x, y):
    vectors = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "id long, embedding array<float>")
    labels = spark.createDataFrame([(k, int(v)) for k, v in enumerate(y)], "id long, label int")
    return vectors, labels


def newton(x, y, ridge):
    x = np.hstack([np.ones((len(x), 1)), x.astype(np.float32).astype(float)])
    penalty = np.full(x.shape[1], ridge * len(y))
    penalty[0] = 0
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ w))
        w = w + np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(penalty), x.T @ (y - p) - penalty * w)
    return w


def test_weights_are_newton_s(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(400, 5))
    y = (draw.random(400) < 1 / (1 + np.exp(-(x @ [2, -1, 0, 0.5, 0] + 0.7)))).astype(int)
    vectors, labels = rows_of(spark, x, y)
    path = logistic.fit_logistic(vectors.repartition(7), labels, scratch_path(spark, "logistic"))
    model = spark.read.parquet(path).first()
    assert np.allclose([model["intercept"], *model["coefficients"]], newton(x, y, logistic.RIDGE), atol=1e-7)


def test_classes_apart_and_odd_rows(spark):
    """Perfectly separable classes, repeated and foreign labels, items without a vector, and no labels."""
    x = np.array([[-2.0], [-1.0], [1.0], [2.0]])
    vectors, labels = rows_of(spark, x, [0, 0, 1, 1])
    vectors = vectors.union(spark.createDataFrame([(9, None)], vectors.schema))
    more = labels.union(spark.createDataFrame([(3, 1), (9, 1), (2, 7), (2, None)], "id long, label int"))
    path = logistic.fit_logistic(vectors, more, scratch_path(spark, "logistic"))
    model = spark.read.parquet(path).first()
    assert np.isfinite(model["intercept"]) and model["coefficients"][0] > 1
    empty = logistic.fit_logistic(vectors, labels.limit(0), scratch_path(spark, "logistic"))
    assert spark.read.parquet(empty).first()["intercept"] == 0.0


def test_pooled_is_the_nearest_rising_sequence():
    draw = np.random.default_rng(3)
    for _ in range(50):
        score, weight = draw.random(12).round(1), draw.integers(1, 5, 12).astype(float)
        mean = lambda j, k: (score[j : k + 1] * weight[j : k + 1]).sum() / weight[j : k + 1].sum()  # noqa: B023, E731
        best = [max(min(mean(j, k) for k in range(i, 12)) for j in range(i + 1)) for i in range(12)]
        assert np.allclose(logistic.pooled(score, weight), best)


def test_calibration(spark):
    """Scores that are too sure become the shares that they stand for."""
    draw = np.random.default_rng(4)
    true = draw.random(4000)
    sure = true**3 / (true**3 + (1 - true) ** 3)
    y = (draw.random(4000) < true).astype(int)
    scored = spark.createDataFrame([(k, float(p)) for k, p in enumerate(sure)], "id long, positive double")
    labels = spark.createDataFrame([(k, int(v)) for k, v in enumerate(y)], "id long, label int")
    path = logistic.fit_calibration(scored, labels, scratch_path(spark, "calibration"), bins=64)
    got = np.array([r.p for r in scored.select("id", logistic.calibrated(F.col("positive"), spark, path).alias("p")).orderBy("id").collect()])
    assert np.abs(got - true).mean() < 0.06 < np.abs(sure - true).mean()
    assert (np.diff(got[np.argsort(sure)]) >= 0).all()


@pytest.mark.parametrize("size", [32])
def test_held_out_labels(spark, size):
    sf = "/root/testdata/sf0.01"
    items = tables.document_items(spark, sf).select("id", "text")
    labels = tables.read_table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    part = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5))
    vectors = embed.fit_vectors(items, scratch_path(spark, "vectors"), size)
    rows = embed.mean_vectors(items.join(labels, "id", "left_semi"), vectors).select("id", "embedding")
    model = logistic.fit_logistic(rows.where(part > 1), labels, scratch_path(spark, "logistic"))
    scored = classify.classify(rows.where(part == 1), model)
    calibration = logistic.fit_calibration(scored, labels, scratch_path(spark, "calibration"))
    held = logistic.classify_calibrated(rows.where(part == 0), model, calibration, threshold=0.0).join(labels, "id")
    count, right, brier, base = held.agg(
        F.count("*"), F.sum(((F.col("positive") >= 0.5) == (F.col("label") == 1)).cast("int")),
        F.avg(F.pow(F.col("positive") - F.col("label"), F.lit(2))), F.avg("label"),
    ).first()
    print(f"held out: {right} of {count}, Brier {brier:.4f}, of the share alone {base * (1 - base):.4f}")
    assert right >= 0.85 * count and brier < base * (1 - base)
