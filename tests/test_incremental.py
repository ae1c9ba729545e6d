"""Models that grow batch by batch equal those that are fitted at once."""

import pytest
from pyspark.sql import functions as F

from quillstream.operators import annotate, classify, embed, incremental, terms
from quillstream.session import scratch_path
from quillstream.sources import tables
from quillstream.streaming import io


@pytest.fixture(scope="module")
def items(spark):
    rows = tables.document_items(spark, "/root/testdata/sf0.001").select("id", "text")
    return annotate.with_whitespace_tokens(rows).select("id", "text", "tokens")


def idf_rows(fitted, spark):
    return {(r.term, r.df, round(r.idf, 9)) for r in fitted.read(spark).collect()}, fitted.n_docs, fitted.n_pairs


@pytest.mark.parametrize("fold_after", [None, 1])
def test_idf_with_retried_batches(spark, items, fold_after):
    at_once = terms.fit_idf(items, scratch_path(spark, "idf"))
    model = incremental.GrowingIdf(spark, scratch_path(spark, "state"))
    seen = set()
    for number in (0, 1, 1, 0, 2, 2):
        assert model.add(items.where(F.col("id") % 3 == number), number) == (number not in seen)
        seen.add(number)
        if number == fold_after:
            model.state.fold()
    grown = model.save(scratch_path(spark, "idf"))
    assert idf_rows(grown, spark) == idf_rows(at_once, spark)


def test_a_batch_that_breaks_off_is_not_counted(spark, items, monkeypatch):
    model = incremental.GrowingIdf(spark, scratch_path(spark, "state"))
    first, second = items.where("id % 2 = 0"), items.where("id % 2 = 1")
    assert model.add(first, 0)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(incremental.Store, "publish", die)
        with pytest.raises(KeyboardInterrupt):
            model.add(second, 1)
        with pytest.raises(KeyboardInterrupt):
            model.state.fold()
    assert model.state.totals() == {"n_docs": first.count()}
    assert model.add(second, 1) and not model.add(second, 1)
    assert model.state.totals() == {"n_docs": items.count()}
    model.state.fold()
    plan = model.state.table()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert len(model.state.expire(keep=1, older_than=0)) == 4
    assert idf_rows(model.save(scratch_path(spark, "idf")), spark) == idf_rows(
        terms.fit_idf(items, scratch_path(spark, "idf")), spark
    )


def test_batches_of_two_sources_and_a_fold_meanwhile(spark, items, monkeypatch):
    """A batch that lands while its predecessors are folded stays and counts once."""
    model = incremental.GrowingIdf(spark, scratch_path(spark, "state"))
    for number, source in ((0, "a"), (0, "b")):
        model.add(items.where(F.col("id") % 3 == int(source == "b")), number, source)
    publish = incremental.Store.publish
    calls = []

    def late(store, manifest):
        if not calls:
            calls.append(1)
            model.add(items.where("id % 3 = 2"), 1, "a")
        publish(store, manifest)

    monkeypatch.setattr(incremental.Store, "publish", late)
    model.state.fold()
    now = model.state.now()
    assert now.through == {"a": 0, "b": 0} and set(now.batches) == {"a"} and now.has("a", 1) and not now.has("b", 1)
    assert idf_rows(model.save(scratch_path(spark, "idf")), spark) == idf_rows(
        terms.fit_idf(items, scratch_path(spark, "idf")), spark
    )


def test_vectors_and_classifier(spark, items):
    size = 8
    at_once = embed.fit_vectors(items, scratch_path(spark, "vectors"), size)
    model = incremental.GrowingVectors(spark, scratch_path(spark, "state"), size)
    for number in (0, 1, 1):
        model.add(items.where(F.col("id") % 2 == number), number)
    grown = model.save(scratch_path(spark, "vectors"))

    def table(path):
        return {(r.bucket, r.n, tuple(r.vector)) for r in embed.load_vectors(spark, path).table.collect()}

    assert table(grown) == table(at_once)

    labels = tables.read_table(spark, "/root/testdata/sf0.001", "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    rows = embed.mean_vectors(items, at_once).select("id", "embedding")
    whole = classify.fit_classifier(rows, labels, scratch_path(spark, "classifier"))
    sums = incremental.GrowingClassifier(spark, scratch_path(spark, "state"))
    for number in (0, 1, 0, 2):
        sums.add(rows.where(F.col("id") % 3 == number), labels, number)
    parts = sums.save(scratch_path(spark, "classifier"))
    one, other = (spark.read.parquet(p).first() for p in (whole, parts))
    assert other["coefficients"] == pytest.approx(one["coefficients"], rel=1e-6)
    assert other["intercept"] == pytest.approx(one["intercept"], rel=1e-6)


def test_a_stream_grows_a_model(spark, items, tmp_path):
    items.repartition(5).write.parquet(f"{tmp_path}/items")
    model = incremental.GrowingIdf(spark, f"{tmp_path}/state")
    stream = spark.readStream.schema(items.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/items")
    for _ in range(2):
        io.drain(incremental.grow(stream, model, f"{tmp_path}/checkpoint", fold_every=2))
    assert model.state.now().through == {"stream": 1}
    assert idf_rows(model.save(f"{tmp_path}/idf"), spark) == idf_rows(terms.fit_idf(items, scratch_path(spark, "idf")), spark)


def test_a_growing_model_is_not_rewritten_at_every_fold(spark, monkeypatch):
    """Folding all of it each time writes the square of the batches."""
    model = incremental.GrowingIdf(spark, scratch_path(spark, "state"))
    folded = []
    summed = incremental.SumState._summed
    monkeypatch.setattr(incremental.SumState, "_summed", lambda self, folders, *a: folded.append(len(folders)) or summed(self, folders, *a))
    for number in range(8):
        model.add(spark.createDataFrame([([f"own{number}", "shared"],)], "tokens array<string>"), number)
        if number % 2:
            model.state.fold(whole=False)
    assert folded == [2, 3, 2, 4] and [n for _, n in model.state.now().parts] == [8]
    assert model.state.now().through == {"stream": 7} and not model.state.now().batches
    model.add(spark.createDataFrame([(["shared"],)], "tokens array<string>"), 8)
    found = {r.term: r.df for r in model.save(scratch_path(spark, "idf")).read(spark).collect()}
    assert found == {"shared": 9} | {f"own{k}": 1 for k in range(8)}
    model.state.fold()
    assert model.state.now().parts == [] and len(model.state.now().folders()) == 1
