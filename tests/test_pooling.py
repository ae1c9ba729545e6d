"""Weighted means without their first component."""

import random

import numpy as np
import pytest

from quillstream.operators import annotate, embed, pooling
from quillstream.session import scratch_path


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id AS id", "text")
    vectors = embed.fit_vectors(docs, scratch_path(spark, "vectors"), size=32)
    rows = annotate.annotation_rows(
        annotate.with_sentences(annotate.with_document(docs)), "sentence", "id"
    ).selectExpr("id", "position", "result AS text")
    return rows, vectors, pooling.fit_pooling(rows, vectors, scratch_path(spark, "pooling"))


def brute(spark, texts, vectors, rare=pooling.RARE):
    model = embed.load_vectors(spark, vectors)
    table = {r["bucket"]: (r["n"], np.array(r["vector"])) for r in model.table.collect()}
    words = sum(n for n, _ in table.values())
    codes = [
        [w % model.buckets for w in r["codes"]]
        for r in texts.select(
            embed.F.transform(embed.model_words(embed.F.col("text")), embed.word_code).alias("codes")
        ).collect()
    ]
    none = (0, np.zeros(model.size))
    means = np.array(
        [
            np.mean([rare / (rare + n / words) * v for n, v in (table.get(c, none) for c in of)], axis=0)
            if of
            else np.zeros(model.size)
            for of in codes
        ]
    )
    direction = np.linalg.svd(means, full_matrices=False)[2][0]
    return means - np.outer(means @ direction, direction)


def test_against_brute_force(spark, fitted):
    rows, vectors, path = fitted
    rows = rows.orderBy("id", "position")
    got = np.array([r["embedding"] for r in pooling.pooled_vectors(rows, path).orderBy("id", "position").collect()])
    assert np.abs(got - brute(spark, rows, vectors)).max() < 1e-5


def test_what_is_left_has_no_common_direction(spark, fitted):
    rows, _, path = fitted
    direction = np.array(spark.read.parquet(f"{path}/component").first()["direction"])
    got = np.array([r["embedding"] for r in pooling.pooled_vectors(rows, path).collect()])
    assert abs(np.linalg.norm(direction) - 1) < 1e-9 and np.abs(got @ direction).max() < 1e-5


def test_near_sentences_rank_above_random_ones(spark, fitted):
    """Sentences that lost a third of their words against others of the same table: how often the near one is
    the nearest."""
    rows, vectors, path = fitted
    draw = random.Random(7)
    texts = sorted({r["text"] for r in rows.collect() if len(r["text"].split()) >= 8})
    chosen = draw.sample(texts, min(300, len(texts)))
    spoilt = [" ".join(w for w in t.split() if draw.random() < 0.67) for t in chosen]
    pairs = spark.createDataFrame([(k, t) for k, t in enumerate(chosen + spoilt)], "id long, text string")

    def hits(vectors_of):
        x = np.array([r["embedding"] for r in vectors_of.orderBy("id").collect()], dtype=float)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        near = x[len(chosen) :] @ x[: len(chosen)].T
        return (near.argmax(axis=1) == np.arange(len(chosen))).mean()

    plain, pooled = hits(embed.mean_vectors(pairs, vectors)), hits(pooling.pooled_vectors(pairs, path))
    print(f"nearest is the planted one: {plain:.3f} plain, {pooled:.3f} pooled, of {len(chosen)}")
    assert pooled > plain and pooled > 0.8


def test_texts_without_words(spark, fitted, tmp_path):
    _, vectors, path = fitted
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "id long, text string")
    assert all(not any(r["embedding"]) for r in pooling.pooled_vectors(odd, path).collect())
    empty = pooling.fit_pooling(odd.limit(0), vectors, scratch_path(spark, "pooling"))
    assert not any(spark.read.parquet(f"{empty}/component").first()["direction"])
    assert pooling.pooled_vectors(odd, empty).count() == 3


def test_the_shared_part_is_found_once_a_row(spark, fitted):
    """It was an aggregate inside a lambda, once for each number of a vector."""
    rows, _, path = fitted
    plan = pooling.pooled_vectors(rows.select("text"), path)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == rows.select("text")._jdf.queryExecution().optimizedPlan().toString().count("aggregate(")
