"""Embeddings, classification, composed stages and the two jobs."""

import hashlib
import json
import math
import random
from collections import defaultdict

import numpy as np
import pytest
import regex
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from quillstream.functions import text as X
from quillstream.operators import annotate, classify, embed
from quillstream.operators.stages import EmbeddingStage, KeywordStage, SentimentStage
from quillstream.plans import jobs
from quillstream.session import scratch_path
from quillstream.sources import tables
from quillstream.streaming import io

SIZE = 16


@pytest.fixture(scope="module")
def items(spark):
    """Two kinds of text that a classifier can tell apart."""
    rng = random.Random(2)
    good, bad = ["great", "nice", "love", "fine"], ["awful", "broken", "hate", "poor"]
    rows = []
    for i in range(240):
        words = rng.choices(good if i % 2 else bad, k=12) + rng.choices(["the", "it", "is"], k=6)
        rng.shuffle(words)
        rows.append((i, " ".join(words[:9]).capitalize() + ". " + " ".join(words[9:]) + ".", i % 2))
    return spark.createDataFrame(rows, "id bigint, text string, label int").repartition(2).cache()


@pytest.fixture(scope="module")
def models(spark, items):
    train = items.where("id < 160")
    return jobs.train_models(
        train.select("id", "text"),
        train.select("id", "label"),
        scratch_path(spark, "models"),
        size=SIZE,
    )


def code(word):
    return int(hashlib.md5(word.encode()).hexdigest()[:13], 16)


def words_of(text):
    return regex.findall(X.TOKEN, text.lower())


def counted_vectors(texts, size, window, buckets):
    """Brute force: one unit for every word near a word."""
    counts = defaultdict(lambda: [0] * size)
    for text in texts:
        codes = [code(w) for w in words_of(text)]
        for i, c in enumerate(codes):
            for n in codes[max(0, i - window) : i + window + 1]:
                counts[c % buckets][(n >> 18) % (1 << 33) % size] += 1 if n >> 51 else -1
    vectors = {}
    for bucket, row in counts.items():
        logs = [math.copysign(math.log1p(abs(n)), n) for n in row]
        norm = math.sqrt(sum(t * t for t in logs)) or 1.0
        vectors[bucket] = [math.floor(t / norm * embed.SCALE + 0.5) / embed.SCALE for t in logs]
    return vectors


@pytest.fixture(scope="module")
def words(items):
    """The vectors that the models should hold, by bucket."""
    texts = [r.text for r in items.where("id < 160").collect()]
    return counted_vectors(texts, SIZE, 2, embed.BUCKETS)


@pytest.mark.parametrize("window, buckets", [(1, embed.BUCKETS), (2, 7), (3, 1)])
def test_vectors_by_brute_force(spark, window, buckets):
    """Few buckets, so words share them; one text holds a word a third of the time."""
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["hot", "a", "b", "c-d", "e"], [4, 2, 2, 2, 2], k=n)) for n in (0, 1, 2, 3, 400)]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "text string").repartition(3)
    path = embed.fit_vectors(rows, scratch_path(spark, "v"), size=5, window=window, buckets=buckets)
    model = embed.load_vectors(spark, path)
    found = {r.bucket: r for r in model.table.collect()}
    assert {b: r.vector for b, r in found.items()} == counted_vectors(texts, 5, window, buckets)
    assert sum(r.n for r in found.values()) == sum(len(words_of(t)) for t in texts)
    assert (model.size, model.buckets, model.n_bytes) == (5, buckets, 20 * buckets)
    with pytest.raises(Exception, match="already exists"):
        embed.fit_vectors(rows, path)


def test_vectors_of_an_empty_table(spark):
    path = embed.fit_vectors(spark.createDataFrame([], "text string"), scratch_path(spark, "v"), size=3)
    rows = spark.createDataFrame([("a b",), (None,)], "text string")
    assert [r.embedding for r in embed.mean_vectors(rows, path).collect()] == [[0.0] * 3] * 2


def test_document_vectors_are_means(items, models, words):
    rows = embed.mean_vectors(items.select("id", "text"), models.vectors).limit(5).collect()
    for r in rows:
        expected = np.mean([words[code(t) % embed.BUCKETS] for t in words_of(r.text)], axis=0)
        assert r.embedding == pytest.approx(expected, abs=1e-6)


def test_unknown_words_give_zeros(spark, models):
    rows = spark.createDataFrame([(1, "zzz qqq"), (2, ""), (3, None)], "id bigint, text string")
    for r in embed.mean_vectors(rows, models.vectors).collect():
        assert r.embedding == [0.0] * SIZE
    token = annotate.with_tokens(annotate.with_document(rows), units="document")
    vectors = embed.token_vectors(token, models.vectors).collect()
    assert [(v.token, v.embedding) for v in vectors] == [("zzz", [0.0] * SIZE), ("qqq", [0.0] * SIZE)]


def test_stage_vectors_equal_the_flat_ones(spark, items, models):
    """The row-shaped encoder against the exploded forms, for tokens and sentences."""
    rows = annotate.with_sentences(annotate.with_document(items.limit(20)))
    rows = annotate.with_tokens(rows).cache()
    by_token = EmbeddingStage(inputCol="token", outputCol="e", modelPath=models.vectors)
    got = annotate.annotation_rows(by_token.transform(rows), "e", "id")
    flat = embed.token_vectors(rows, models.vectors)
    pairs = got.join(flat.select("id", "position", F.col("embedding").alias("x")), ["id", "position"])
    assert pairs.count() == flat.count() > 300
    for r in pairs.collect():
        assert r.embeddings == pytest.approx(r.x, abs=1e-5)

    by_sentence = EmbeddingStage(inputCol="sentence", outputCol="e", modelPath=models.vectors)
    got = annotate.annotation_rows(by_sentence.transform(rows), "e", "id")
    flat = embed.mean_vectors(annotate.annotation_rows(rows, "sentence", "id"), models.vectors, "result")
    pairs = got.join(flat.select("id", "position", F.col("embedding").alias("x")), ["id", "position"])
    assert pairs.count() == 40
    for r in pairs.collect():
        assert r.embeddings == pytest.approx(r.x, abs=1e-5)
        assert r.annotatorType == "sentence_embeddings"


def test_encoder_in_small_batches(spark, items, models):
    """Results that leave in batches of few vectors still meet their own rows."""
    units = F.transform(F.array(F.col("text"), F.lit("")), embed.model_words)
    units = F.when(F.col("id") != 7, units)
    whole = embed.vector_encoder(spark, models.vectors)
    small = embed.vector_encoder(spark, models.vectors, flush_vectors=3)
    rows = items.select("id", whole(units).alias("a"), small(units).alias("b")).collect()
    assert len(rows) == 240 and all(r.a == r.b for r in rows)
    assert [r.id for r in rows if r.a is None] == [7]
    assert rows[0].a[1] == [0.0] * SIZE
    assert embed.vector_encoder(spark, models.vectors) is whole


def test_vectors_beyond_the_broadcast_limit(spark, models, monkeypatch):
    monkeypatch.setattr(embed, "BROADCAST_BYTES", 0)
    with pytest.raises(ValueError, match="too many to broadcast"):
        embed.vector_encoder(spark, models.vectors, flush_vectors=11)


def test_large_vector_table_is_not_broadcast(spark, items, models, monkeypatch):
    rows = annotate.with_tokens(annotate.with_document(items.limit(10)), units="document").cache()
    expected = {(r.id, r.position): r.embedding for r in embed.token_vectors(rows, models.vectors).collect()}
    monkeypatch.setattr(embed, "BROADCAST_BYTES", 0)
    shuffled = embed.token_vectors(rows, models.vectors).collect()
    assert {(r.id, r.position): r.embedding for r in shuffled} == expected


def test_classifier_learns(items, models):
    held_out = embed.mean_vectors(items.where("id >= 160"), models.vectors)
    rows = classify.classify(held_out, models.classifier, threshold=0.5).collect()
    right = sum((r.sentiment == "positive") == (r.label == 1) for r in rows)
    # Always guessing the larger class gets half of them.
    assert right / len(rows) > 0.9


def test_threshold(items, models):
    vectors = embed.mean_vectors(items, models.vectors)
    neutral = []
    for threshold in (0.5, 0.7, 0.9, 0.999, 1.01):
        rows = classify.classify(vectors, models.classifier, threshold).collect()
        for r in rows:
            sure = max(r.positive, 1 - r.positive) >= threshold
            side = "positive" if r.positive >= 0.5 else "negative"
            assert r.sentiment == (side if sure else "neutral")
        neutral.append(sum(r.sentiment == "neutral" for r in rows))
    assert neutral == sorted(neutral) and neutral[0] == 0 and neutral[-1] == 240


def test_repeated_labels_are_weights(spark, items, models):
    """A label repeated very often changes weights, not the number of training rows."""
    vectors = embed.mean_vectors(items.select("id", "text"), models.vectors).drop("text")
    once = items.select("id", "label")
    often = once.union(spark.range(1000).select(F.lit(1).cast("bigint").alias("id"), F.lit(1).alias("label")))
    path = classify.fit_classifier(vectors, often, scratch_path(spark, "classifier"))
    assert classify.classify(vectors, path).count() == 240


def test_classifier_by_brute_force(spark):
    rows = [(1, [0.0, 1.0], 0), (2, [2.0, 1.0], 0), (3, [3.0, 1.0], 1), (4, [5.0, 1.0], 1), (4, [5.0, 1.0], 1)]
    vectors = spark.createDataFrame([r[:2] for r in rows[:4]] + [(9, [7.0, 7.0])], "id int, embedding array<float>")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(1, None), (2, 5)], "id int, label int")
    path = classify.fit_classifier(vectors, labels, scratch_path(spark, "classifier"))
    # Class means 1 and 13/3; squares within the classes 2 and 8/3; the second number tells nothing.
    variance = (2 + 8 / 3) / 5 + classify.LEAST_VARIANCE
    coefficient = (13 / 3 - 1) / variance
    middle = ((13 / 3) ** 2 - 1) / (2 * variance)
    for r in classify.classify(vectors, path).collect():
        logit = math.log(4 / 3) + coefficient * r.embedding[0] - middle
        assert r.positive == pytest.approx(1 / (1 + math.exp(-min(30, max(-30, logit)))))


@pytest.mark.parametrize("labels, positive", [([], 0.5), ([(1, 1)], 2 / 3), ([(1, 0), (2, 0)], 0.25)])
def test_classifier_without_both_classes(spark, labels, positive):
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], "id int, embedding array<float>")
    labels = spark.createDataFrame(labels, "id int, label int")
    path = classify.fit_classifier(vectors, labels, scratch_path(spark, "classifier"))
    for r in classify.classify(vectors, path).collect():
        assert r.positive == pytest.approx(positive)


def test_sentiment_stage_equals_the_flat_one(items, models):
    rows = annotate.with_document(items)
    rows = EmbeddingStage(inputCol="document", outputCol="e", modelPath=models.vectors).transform(rows)
    stage = SentimentStage(inputCol="e", outputCol="s", modelPath=models.classifier, threshold=0.7)
    got = {r.id: r.s[0] for r in stage.transform(rows).select("id", "s").collect()}
    plain = classify.classify(embed.mean_vectors(items, models.vectors), models.classifier, 0.7)
    for r in plain.collect():
        assert got[r.id].result == r.sentiment and got[r.id].annotatorType == "category"
        assert float(got[r.id].metadata["positive"]) == pytest.approx(r.positive, abs=1e-5)


def test_composed_stages_survive_saving(spark, items, models):
    text = items.select("id", "text")
    per_document = jobs.sentence_stages(models, token_units="document")
    for stages in (jobs.document_stages(models), jobs.sentence_stages(models), per_document):
        fitted = jobs.compose(stages, text)
        path = scratch_path(spark, "saved")
        fitted.write().overwrite().save(path)
        loaded = PipelineModel.load(path)
        assert [type(s) for s in loaded.stages] == [type(s) for s in fitted.stages]
        as_json = F.to_json(F.struct("*")).alias("v")
        before = sorted(r.v for r in fitted.transform(text).select(as_json).collect())
        assert before == sorted(r.v for r in loaded.transform(text).select(as_json).collect())
    keyword = KeywordStage(inputCol="token", outputCol="k", nKeywords=3)
    keyword.save(path + "-k")
    assert KeywordStage.load(path + "-k").getOrDefault("nKeywords") == 3


@pytest.mark.parametrize("kind", ["document", "sentence"])
def test_jobs_on_a_stream_equal_batch(spark, items, models, kind):
    work = scratch_path(spark, kind)
    topic = tables.land_topic(items.select("id", "text"), "id", f"{work}/topic", rows_per_file=80)
    text = items.select("id", "text")
    if kind == "document":
        job, fitted = jobs.annotate_documents, jobs.compose(jobs.document_stages(models), text)
        columns = {
            "id", "text", "document", "sentence", "tokens", "token", "sentence_embeddings",
            "sentiment", "raw_tf", "bert_embeddings", "wordCount",
        }
    else:
        job, fitted = jobs.annotate_sentences, jobs.compose(jobs.sentence_stages(models), text)
        columns = {
            "id", "text", "document", "sentence", "token", "bert_sentence_embeddings",
            "sentence_embeddings", "sentiment", "keywords",
        }
    batch = job(spark.read.parquet(topic), fitted)
    assert "Exchange" not in batch._jdf.queryExecution().executedPlan().toString()
    stream = job(io.read_record_files(spark, topic, max_per_trigger=1), fitted)
    io.drain(io.write_files(stream, f"{work}/out", f"{work}/checkpoint"))
    as_json = F.to_json(F.struct("*")).alias("v")
    got = sorted(r.v for r in spark.read.parquet(f"{work}/out").select(as_json).collect())
    assert got == sorted(r.v for r in batch.select(as_json).collect()) and len(got) == 240
    if kind == "document":
        one = json.loads(json.loads(got[0])["value"])
        assert set(one) == columns
        assert len(one["bert_embeddings"]) == one["wordCount"]
        assert len(one["bert_embeddings"][0]["embeddings"]) == SIZE
    else:
        assert set(batch.columns) == columns
        one = json.loads(got[0])
        assert one["bert_sentence_embeddings"][0]["embeddings"] != one["sentence_embeddings"][0]["embeddings"]


def test_ghosts(spark, items):
    raw = spark.createDataFrame(
        [("1", '{"id":1,"text":"a"}'), ("2", "null"), ("3", None)], "key string, value string"
    )
    assert {(r.id, r.text) for r in jobs.prepare(raw, ".").collect()} == {(1, "a"), (None, ".")}
    assert jobs.prepare(raw).count() == 3
    assert jobs.prepare(raw, keep_ghosts=False).count() == 1


def test_counting_sends_a_bucket_of_a_task_once(spark):
    """Before, each task sent a row for each number of a bucket, and each word's hash was taken at all its places."""
    rows = spark.createDataFrame([("a b a c " * 50,)] * 40, "text string").repartition(3)
    counts = embed.neighbour_counts(rows, 8, 2)
    sent = embed._bucket_counts(rows, 8, 2, embed.BUCKETS)
    assert sent.count() <= 3 * 3
    assert "md5" not in counts._jdf.queryExecution().toString()
    assert counts.agg(F.sum("own")).first()[0] == 40 * 200
    path = embed.vectors_of(counts, scratch_path(spark, "v"), 8)
    found = {r.bucket: (r.n, r.vector) for r in spark.read.parquet(f"{path}/vectors").collect()}
    whole = embed.load_vectors(spark, embed.fit_vectors(rows, scratch_path(spark, "v"), 8)).table.collect()
    assert found == {r.bucket: (r.n, r.vector) for r in whole}


def test_document_values_are_read_line_by_line(spark, small):
    """As parquet, thousands of values of any length were in memory at a time."""
    from quillstream.plans import registry

    files = registry.document_job(spark, small).inputFiles()
    assert files and all(".txt" in f for f in files)


def test_document_values_take_little_disk(spark, small):
    """As lz4 they took 36 times the documents; every value is still there, as it was."""
    from quillstream.plans import registry

    files = registry.document_job(spark, small).inputFiles()
    assert files and all(f.endswith(".txt.zstd") for f in files)
    values = spark.read.text(files)
    whole = F.col("value").startswith('{"id":') & F.col("value").endswith("}")
    assert values.count() == values.where(whole).count() == 200
    assert spark.conf.get("parquet.compression.codec.zstd.level", None) is None


def test_sentence_rows_take_little_disk(spark, small):
    """With Snappy they took 12 times the documents."""
    from quillstream.plans import registry

    files = registry.sentence_job(spark, small).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert spark.read.parquet(*files).count() == 200


def test_words_are_hashed_together(monkeypatch):
    """Before, word by word in Python, which took most of the time of the vectors."""
    import pyarrow as pa

    monkeypatch.setattr(embed, "_KNOWN", {})
    words = ["a", "", "é", "x" * 100, "日本", *[f"w{k}" for k in range(50)]]
    expected = [int(hashlib.md5(w.encode()).hexdigest()[:13], 16) for w in words]
    for known in (0, len(words) - 1):
        assert len(embed._KNOWN) == known
        assert embed._codes(pa.array(words)).tolist() == expected
    assert embed._codes(pa.array(words).slice(2, 3)).tolist() == expected[2:5]
    assert len(embed._codes(pa.array([], pa.string()))) == 0


@pytest.mark.parametrize("longest", [4096, 3, 0])
def test_means_of_long_and_empty_runs(monkeypatch, longest):
    monkeypatch.setattr(embed, "RUN_CODES", longest)
    vectors = (np.arange(-60, 60, dtype=np.float32) / 64).reshape(40, 3)
    lengths = np.array([2, 0, 7, 1, 0, 3])
    codes = np.arange(13) * 7 % 40
    runs = np.split(codes, np.cumsum(lengths)[:-1])
    expected = [vectors[r].astype(float).sum(axis=0) / max(len(r), 1) for r in runs]
    assert embed._means(codes, lengths, vectors, 2).tolist() == np.float32(expected).tolist()
    assert embed._means(codes[:0], lengths[:0], vectors, 2).shape == (0, 3)


def test_vectors_as_text(spark):
    """On Arrow batches as by Spark's own functions; before, it was done by lambdas that Spark interprets."""
    numbers = [0.5, -0.25, 0.00005, -0.00005, 0.0, -0.0, 0.123456789, -0.3, 1.0]
    rows = spark.createDataFrame([(numbers,), ([],), (None,), ([-1.0],)], "v array<float>")
    down = F.array_join(F.transform("v", lambda x: F.floor(x.cast("double") * 1e6).cast("string")), ",")
    near = F.transform("v", lambda x: F.round(x.cast("double") * 1e4).cast("long").cast("string"))
    texts = embed.vector_text(1e6)("v"), embed.vector_text(1e4, rounded=True)("v")
    for r in rows.select(down, texts[0], F.array_join(near, ","), texts[1]).collect():
        assert r[0] == r[1] and r[2] == r[3]


def test_a_vector_is_made_a_text_once_for_each_bucket(spark, items, models, monkeypatch):
    """Before, for each token; and rows came text by text, of which equal vectors were far apart in the files."""
    rows = annotate.with_tokens(annotate.with_document(items.select("id", "text")), units="document").cache()
    plain = {(r.id, r.position): (r.token, r.embedding) for r in embed.token_vectors(rows, models.vectors).collect()}
    found = embed.token_vectors(rows.coalesce(1), models.vectors, form=embed.vector_text(1e6))
    got = found.collect()
    for r in got:
        token, vector = plain.pop((r.id, r.position))
        assert r.token == token
        assert r.embedding == ",".join(str(int(np.floor(float(x) * 1e6))) for x in vector)
    assert not plain
    words = [r.token.lower() for r in got]
    assert sum(a != b for a, b in zip(words, words[1:], strict=False)) == len(set(words)) - 1
    # In parts of few words the rows are the same.
    monkeypatch.setattr(embed, "FLUSH_WORDS", 7)
    again = embed.token_vectors(rows, models.vectors, form=embed.vector_text(1e6))
    assert sorted(again.collect()) == sorted(got)


def test_token_vectors_of_null_and_empty_texts(spark, models):
    rows = spark.createDataFrame([("x", None), (None, "a B a"), ("y", "")], "id string, text string")
    token = annotate.with_tokens(annotate.with_document(rows), units="document")
    found = embed.token_vectors(token, models.vectors).collect()
    assert sorted((r.id, r.position, r.token) for r in found) == [(None, 0, "a"), (None, 1, "B"), (None, 2, "a")]


@pytest.mark.parametrize("most", [1000, 0])
def test_labelled_texts_are_not_shuffled(spark, items, models, monkeypatch, most):
    """Before, where the labels were too many for Spark to broadcast, all texts were sorted to meet them."""
    monkeypatch.setattr(jobs, "BROADCAST_IDS", most)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        labels = items.where("id < 20").select("id", F.lit(1).alias("label"))
        rows = jobs.labelled_vectors(items, labels.union(labels), models.vectors)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        expected = embed.mean_vectors(items.select("id", "text"), models.vectors)
        if most:
            expected = expected.where("id < 20")
        expected = {r.id: r.embedding for r in expected.collect()}
        assert {r.id: r.embedding for r in rows.collect()} == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_streams_of_annotated_items_have_settings_of_their_own(spark):
    """Before, 2,000 whole rows waited beside each batch, gigabytes in all."""
    names = list(io.ANNOTATED)
    before = [spark.conf.get(n, None) for n in names]
    with pytest.raises(ValueError, match="stop"), io.settings(spark, io.ANNOTATED):
        assert [spark.conf.get(n) for n in names] == ["6", "200"]
        raise ValueError("stop")
    assert [spark.conf.get(n, None) for n in names] == before
