"""The registered queries: every operator over the test tables, one result DataFrame each."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.operators import annotate, classify, embed, incremental, ingest, logistic, pooling, records, terms
from quillstream.operators.rows import each
from quillstream.plans import jobs
from quillstream.session import scratch_path, spread
from quillstream.sources import archive, frontier, tables
from quillstream.streaming import io

Query = Callable[[SparkSession, str], DataFrame]

PLACES = 6
# Small vectors keep the results of the embedding queries readable; the default is 128.
VECTOR_SIZE = 16
ITEM_COLUMNS = ["id", "type", "by", "time", "text"]


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return spread(tables.document_items(spark, sf))


def _document_topic(spark: SparkSession, sf: str) -> DataFrame:
    return tables.as_topic(_items(spark, sf), "id")


def _event_rows(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "props"
    )


def _max(df: DataFrame, column: str) -> int:
    return df.agg(F.max(column)).first()[0]


# Sources and ingestion


def frontier_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Event ids above the highest document id."""
    last = _max(tables.read_table(spark, sf, "documents"), "doc_id")
    newest = _max(tables.read_table(spark, sf, "events"), "event_id")
    return ingest.frontier_delta(spark, last, newest)


def stream_frontier(spark: SparkSession, sf: str) -> DataFrame:
    """The same ids from the streaming source: the first poll sets the mark, the second emits."""
    last = _max(tables.read_table(spark, sf, "documents"), "doc_id")
    newest = _max(tables.read_table(spark, sf, "events"), "event_id")
    work = scratch_path(spark, "frontier")
    out, checkpoint = f"{work}/ids", f"{work}/checkpoint"
    for seen in (last, newest):
        poll = spark.range(1).select(F.lit(str(seen)).alias("value"))
        poll.write.mode("append").text(f"{work}/newest")
        ids = frontier.frontier_stream(spark, f"{work}/newest", chunk=1000)
        io.drain(io.write_files(ids, out, checkpoint))
    return spark.read.schema("id bigint").parquet(out)


def backfill_range(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.backfill_ids(spark, _max(tables.read_table(spark, sf, "events"), "event_id"))


def progress_sample(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.progress_sample(backfill_range(spark, sf))


def item_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every event id looked up among the documents."""
    ids = tables.read_table(spark, sf, "events").select(F.col("event_id").alias("id"))
    return ingest.item_lookup(ids, tables.document_items(spark, sf)).select(*ITEM_COLUMNS)


def stream_produce(spark: SparkSession, sf: str) -> DataFrame:
    """All ids up to the newest event, as a stream, to records of the documents."""
    work = scratch_path(spark, "produce")
    newest = _max(tables.read_table(spark, sf, "events"), "event_id")
    poll = spark.range(1).select(F.lit(str(newest)).alias("value"))
    poll.write.text(f"{work}/newest")
    ids = frontier.frontier_stream(spark, f"{work}/newest", start_id=-1)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{work}/out/batch={number}")

    io.drain(
        jobs.write_produced(
            ids, lambda: tables.document_items(spark, sf), write, f"{work}/checkpoint"
        )
    )
    return spark.read.parquet(f"{work}/out").drop("batch")


def backfill_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Documents below the newest event id, fetched id by id into an archive."""
    path = scratch_path(spark, "backfill")
    newest = _max(tables.read_table(spark, sf, "events"), "event_id")
    jobs.backfill(spark, newest, tables.document_items(spark, sf), path, "time")
    return ingest.read_archive(spark, path).select(*ITEM_COLUMNS)


def archive_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    archive.write_json_archive(_items(spark, sf), path)
    return archive.scan_json_archive(spark, path).select(*ITEM_COLUMNS)


def archive_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations by id, the last turn wins: user turns first, the others as updates."""
    turns = tables.read_table(spark, sf, "conversations").select(
        F.col("conv_id").alias("id"), "turn", "role", "text"
    )
    path = scratch_path(spark, "archive")
    ingest.write_archive(turns.where("role = 'user'"), path, "turn", block=256)
    ingest.upsert_archive(turns.where("NOT (role <=> 'user')"), path, "turn", block=256)
    return ingest.read_archive(spark, path)


def archive_compact(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations turn by turn into an archive, whose blocks with deltas are compacted twice on the way."""
    turns = tables.read_table(spark, sf, "conversations").select(
        F.col("conv_id").alias("id"), "turn", "role", "text"
    )
    path = scratch_path(spark, "archive")
    part = F.pmod("turn", F.lit(4))
    ingest.write_archive(turns.where(part == 0), path, "turn", block=256)
    for k in (1, 2, 3):
        ingest.upsert_archive(turns.where(part == k), path, "turn")
        if k > 1:
            ingest.compact_blocks(spark, path)
    return ingest.read_archive(spark, path)


def archive_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every event id looked up in an archive of the documents, half of which came as an update."""
    items = tables.document_items(spark, sf).select(*ITEM_COLUMNS)
    path = scratch_path(spark, "archive")
    ingest.write_archive(items.where("id % 2 = 0"), path, "time", block=4096)
    ingest.upsert_archive(items.where("id % 2 <> 0"), path, "time")
    ids = tables.read_table(spark, sf, "events").select(F.col("event_id").alias("id"))
    return ingest.archive_lookup(ids, path)


# Records


def kv_encode(spark: SparkSession, sf: str) -> DataFrame:
    return records.encode_records(_items(spark, sf))


def kv_decode(spark: SparkSession, sf: str) -> DataFrame:
    return records.decode_records(tables.as_topic(_event_rows(spark, sf), "event_id"))


def item_parse(spark: SparkSession, sf: str) -> DataFrame:
    return records.parse_items(_document_topic(spark, sf)).drop("kids", "parts")


def item_normalize(spark: SparkSession, sf: str) -> DataFrame:
    items = records.normalize_items(records.parse_items(_document_topic(spark, sf)))
    return items.select("id", "type", "by", "time", "text", "url", "title", "score")


def item_text(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.prepare(_document_topic(spark, sf))


def drop_ghosts(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads of all event ids; the ids without a document have none and are dropped."""
    found = item_lookup(spark, sf)
    payload = F.when(F.col("type").isNotNull(), F.to_json(F.struct(*ITEM_COLUMNS)))
    raw = found.select(F.col("id").cast("string").alias("key"), payload.alias("value"))
    return records.drop_ghosts(records.parse_items(raw)).select("key", "id", "by", "text")


def json_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return records.json_envelope(tables.to_item_schema(_items(spark, sf)))


def json_field(spark: SparkSession, sf: str) -> DataFrame:
    raw = tables.read_table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("key"), F.col("props").alias("value")
    )
    return records.json_field(raw, "k")


def json_compact(spark: SparkSession, sf: str) -> DataFrame:
    """Pretty-printed payloads, with a field that no schema knows."""
    fields = F.struct("by", F.lit(5).alias("extra"), "id", "text", "time", "type")
    raw = _items(spark, sf).select(
        F.col("id").cast("string").alias("key"), F.to_json(fields, {"pretty": "true"}).alias("value")
    )
    return records.compact_json(raw)


# Text


def _annotated(spark: SparkSession, sf: str) -> DataFrame:
    items = _items(spark, sf).select("id", "text")
    return annotate.with_sentences(annotate.with_document(items))


def doc_assemble(spark: SparkSession, sf: str) -> DataFrame:
    rows = annotate.annotation_rows(annotate.with_document(_items(spark, sf)), "document", "id")
    return rows.select("id", "annotatorType", "begin", "end", "result")


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    rows = annotate.annotation_rows(_annotated(spark, sf), "sentence", "id")
    return rows.select("id", "position", "begin", "end", "result")


def nlp_tokens(spark: SparkSession, sf: str) -> DataFrame:
    tokens = annotate.with_tokens(_annotated(spark, sf))
    rows = annotate.annotation_rows(tokens, "token", "id")
    return rows.select(
        "id",
        "position",
        F.col("metadata")["sentence"].cast("int").alias("sentence"),
        "begin",
        "end",
        "result",
    )


def _whitespace_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return annotate.with_whitespace_tokens(_items(spark, sf).select("id", "text"))


def ws_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return each(_whitespace_tokens(spark, sf), "tokens", "term", "id")


def stop_words(spark: SparkSession, sf: str) -> DataFrame:
    kept = annotate.without_stop_words(_whitespace_tokens(spark, sf))
    return each(kept, "filtered_token", "term", "id")


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.count_words(_document_topic(spark, sf))


def keywords(spark: SparkSession, sf: str) -> DataFrame:
    annotated = annotate.with_keywords(annotate.with_tokens(_annotated(spark, sf)))
    rows = annotate.annotation_rows(annotated, "keywords", "id")
    score = F.round(F.col("metadata")["score"].cast("double"), PLACES)
    return rows.select(
        "id",
        (F.col("position") + 1).alias("rank"),
        "begin",
        "end",
        F.col("result").alias("keyword"),
        score.alias("score"),
    )


# Features


def hashing_tf(spark: SparkSession, sf: str) -> DataFrame:
    """The sparse vectors as rows of item, bucket and count."""
    rows = terms.hashed_term_frequency(_whitespace_tokens(spark, sf))
    parsed = rows.select("id", F.unwrap_udt("raw_tf").alias("v"))
    pairs = each(parsed, F.arrays_zip("v.indices", "v.values"), "p", "id")
    return pairs.select("id", F.col("p.indices").alias("bucket"), F.col("p.values").alias("tf"))


def term_freq(spark: SparkSession, sf: str) -> DataFrame:
    return terms.term_frequency(_whitespace_tokens(spark, sf))


def idf(spark: SparkSession, sf: str) -> DataFrame:
    fitted = terms.fit_idf(_whitespace_tokens(spark, sf), scratch_path(spark, "idf"))
    return fitted.read(spark).select("term", "df", F.round("idf", PLACES).alias("idf"))


def tf_idf(spark: SparkSession, sf: str) -> DataFrame:
    items = _whitespace_tokens(spark, sf)
    fitted = terms.fit_idf(items, scratch_path(spark, "idf"))
    return terms.tf_idf(items, fitted).withColumn("tf_idf", F.round("tf_idf", PLACES))


_MODELS: dict[tuple[str, str], jobs.Models] = {}


def trained_models(spark: SparkSession, sf: str) -> jobs.Models:
    """Models trained on the documents; once per application and table folder."""
    known = (spark.sparkContext.applicationId, os.path.abspath(sf))
    if known not in _MODELS:
        labels = tables.read_table(spark, sf, "labels").select(
            F.col("doc_id").alias("id"), F.col("quality").alias("label")
        )
        items = _items(spark, sf).select("id", "text")
        _MODELS[known] = jobs.train_models(
            items, labels, scratch_path(spark, "models"), size=VECTOR_SIZE
        )
    return _MODELS[known]


def _digits(vector: str):
    """A vector as text: its numbers in millionths, rounded down."""
    return embed.vector_text(1e6)(vector)


def token_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    tokens = annotate.with_tokens(_annotated(spark, sf))
    return embed.token_vectors(tokens, trained_models(spark, sf).vectors, form=_digits)


def doc_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    items = _items(spark, sf).select("id", "text")
    rows = embed.mean_vectors(items, trained_models(spark, sf).vectors)
    return rows.select("id", _digits("embedding").alias("embedding"))


def sentence_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    rows = annotate.annotation_rows(_annotated(spark, sf), "sentence", "id")
    vectors = embed.mean_vectors(rows, trained_models(spark, sf).vectors, text="result")
    return vectors.select("id", "position", _digits("embedding").alias("embedding"))


def sentence_embeddings_pooled(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted means of 128 numbers for all sentences, without their first component."""
    items = _items(spark, sf).select("id", "text")
    rows = annotate.annotation_rows(_annotated(spark, sf), "sentence", "id")
    vectors = embed.fit_vectors(items, scratch_path(spark, "vectors"))
    path = pooling.fit_pooling(rows, vectors, scratch_path(spark, "pooling"), text="result")
    found = pooling.pooled_vectors(rows, path, text="result")
    digits = embed.vector_text(1e4, rounded=True)
    return found.select("id", "position", digits("embedding").alias("embedding"))


def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    models = trained_models(spark, sf)
    vectors = embed.mean_vectors(_items(spark, sf).select("id", "text"), models.vectors)
    labelled = classify.classify(vectors, models.classifier, threshold=0.7)
    return labelled.select("id", F.round("positive", PLACES).alias("positive"), "sentiment")


def sentiment_logistic(spark: SparkSession, sf: str) -> DataFrame:
    """Sentiment by logistic regression on vectors of 128 numbers, calibrated on a fifth of the labelled items
    that the regression has not seen."""
    items = _items(spark, sf).select("id", "text")
    labels = tables.read_table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label")
    )
    part = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5))
    vectors = embed.mean_vectors(items, embed.fit_vectors(items, scratch_path(spark, "vectors")))
    model = logistic.fit_logistic(vectors.where(part != 0), labels, scratch_path(spark, "logistic"))
    scored = classify.classify(vectors.where(part == 0), model)
    calibration = logistic.fit_calibration(scored, labels, scratch_path(spark, "calibration"))
    found = logistic.classify_calibrated(vectors, model, calibration, threshold=0.7)
    return found.select("id", F.round("positive", PLACES).alias("positive"), "sentiment")


# Composition, models and jobs


def annotate_items(spark: SparkSession, sf: str) -> DataFrame:
    """The model-free stages composed and applied in one go."""
    items = jobs.prepare(_document_topic(spark, sf))
    rows = jobs.compose(jobs.text_stages(), items).transform(items)
    return rows.select(
        "id",
        F.size("document").alias("documents"),
        F.size("sentence").alias("sentences"),
        F.size("tokens").alias("tokens"),
        "wordCount",
    )


def _vector_total(vector: str):
    """Sum of a sparse vector without making it dense."""
    values = F.unwrap_udt(vector).getField("values")
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v).cast("long")


def annotate_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted stages applied to a stream of records."""
    work = scratch_path(spark, "annotate")
    topic = tables.land_topic(_items(spark, sf), "id", f"{work}/topic")
    fitted = jobs.compose(jobs.text_stages(), _items(spark, sf).select("id", "text"))
    stream = jobs.prepare(io.read_record_files(spark, topic, max_per_trigger=8))
    rows = fitted.transform(stream).select(
        "id",
        F.size("sentence").alias("sentences"),
        _vector_total("raw_tf").alias("tf_total"),
        "wordCount",
    )
    io.drain(io.write_files(rows, f"{work}/out", f"{work}/checkpoint"))
    return spark.read.parquet(f"{work}/out")


def fit_apply(spark: SparkSession, sf: str) -> DataFrame:
    """IDF fitted on the documents, applied to a stream of conversation turns."""
    work = scratch_path(spark, "fit-apply")
    fitted = terms.fit_idf(_whitespace_tokens(spark, sf), f"{work}/idf")
    turns = tables.read_table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), "text"
    )
    turns.write.option("maxRecordsPerFile", 5000).parquet(f"{work}/turns")
    stream = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 2)

    def weights(batch: DataFrame) -> DataFrame:
        return terms.tf_idf(annotate.with_whitespace_tokens(batch), fitted, batch=True)

    turns_ = stream.parquet(f"{work}/turns")
    io.drain(io.write_batches(turns_, weights, f"{work}/out", f"{work}/checkpoint"))
    return spark.read.parquet(f"{work}/out/batch=*").withColumn("tf_idf", F.round("tf_idf", PLACES))


def stream_fit(spark: SparkSession, sf: str) -> DataFrame:
    """IDF that grows with a stream of the documents, batch by batch."""
    work = scratch_path(spark, "stream-fit")
    texts = _items(spark, sf).select("id", "text")
    texts.write.option("maxRecordsPerFile", 2000).parquet(f"{work}/items")
    # A file is a task, so a batch has one for every core.
    files = max(3, spark.sparkContext.defaultParallelism)
    stream = spark.readStream.schema(texts.schema).option("maxFilesPerTrigger", files).parquet(f"{work}/items")
    model = incremental.GrowingIdf(spark, f"{work}/state")
    items = annotate.with_whitespace_tokens(stream)
    io.drain(incremental.grow(items, model, f"{work}/checkpoint", fold_every=4))
    fitted = model.save(f"{work}/idf").read(spark)
    return fitted.select("term", "df", F.round("idf", PLACES).alias("idf"))


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The hashed TF-IDF of a fitted model that was saved and loaded, as rows of item and bucket."""
    items = _items(spark, sf).select("id", "text")
    model = Pipeline(
        stages=[
            Tokenizer(inputCol="text", outputCol="tokens"),
            HashingTF(inputCol="tokens", outputCol="raw_tf"),
            IDF(inputCol="raw_tf", outputCol="tf_idf"),
        ]
    ).fit(items)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    after = PipelineModel.load(path).transform(items).select("id", F.unwrap_udt("tf_idf").alias("v"))
    pairs = each(after, F.arrays_zip("v.indices", "v.values"), "p", "id")
    return pairs.select(
        "id", F.col("p.indices").alias("bucket"), F.round("p.values", PLACES).alias("tf_idf")
    )


def document_job(spark: SparkSession, sf: str) -> DataFrame:
    """The whole per-document job on a stream, to JSON values in a file sink, and back."""
    work = scratch_path(spark, "document-job")
    models = trained_models(spark, sf)
    topic = tables.land_topic(_items(spark, sf), "id", f"{work}/topic")
    fitted = jobs.compose(
        jobs.document_stages(models, threshold=0.7), _items(spark, sf).select("id", "text")
    )
    values = jobs.annotate_documents(io.read_record_files(spark, topic), fitted)
    # An item's JSON is a hundred times its text: as lines it is read one by one, as parquet thousands at a time.
    sink = io.write_files(values, f"{work}/out", f"{work}/checkpoint", fmt="text")
    with io.settings(spark, io.ANNOTATED):
        io.drain(sink.option("compression", io.ZSTD_LINES))
    schema = (
        "id bigint, wordCount int, sentiment array<struct<result string>>, sentence_embeddings "
        "array<struct<embeddings array<float>>>, bert_embeddings array<struct<embeddings array<float>>>"
    )
    parsed = spark.read.schema(schema).option("io.compression.codecs", io.ZSTD_LINES).json(f"{work}/out")
    # Each product is a whole number; ``round`` would go through decimals.
    units = F.aggregate(
        F.flatten("bert_embeddings.embeddings"),
        F.lit(0).cast("long"),
        lambda total, x: total + F.rint(x.cast("double") * embed.SCALE).cast("long"),
    )
    return parsed.select(
        "id",
        "wordCount",
        F.size("bert_embeddings").alias("token_vectors"),
        units.alias("token_total"),
        F.array_join("sentiment.result", ",").alias("sentiment"),
        _digits(F.col("sentence_embeddings")[0]["embeddings"]).alias("embedding"),
    )


def sentence_job(spark: SparkSession, sf: str) -> DataFrame:
    """The whole per-sentence job on a stream; a row per sentence."""
    work = scratch_path(spark, "sentence-job")
    models = trained_models(spark, sf)
    topic = tables.land_topic(_items(spark, sf), "id", f"{work}/topic")
    fitted = jobs.compose(jobs.sentence_stages(models), _items(spark, sf).select("id", "text"))
    rows = jobs.annotate_sentences(io.read_record_files(spark, topic), fitted)
    # A text is there five times in a row, and each token with its offsets.
    sink = io.write_files(rows, f"{work}/out", f"{work}/checkpoint")
    with io.settings(spark, io.ANNOTATED):
        io.drain(sink.option("compression", "zstd"))
    annotated = spark.read.parquet(f"{work}/out").withColumn("n_keywords", F.size("keywords"))
    each_one = F.arrays_zip("sentiment", "sentence_embeddings", "bert_sentence_embeddings")
    sentences_ = each(annotated, each_one, "s", "id", "n_keywords")
    return sentences_.select(
        "id",
        "position",
        "s.sentiment.begin",
        "s.sentiment.end",
        F.col("s.sentiment.result").alias("sentiment"),
        _digits("s.sentence_embeddings.embeddings").alias("embedding"),
        _digits("s.bert_sentence_embeddings.embeddings").alias("second"),
        "n_keywords",
    )


# Streams


def _event_topic(spark: SparkSession, sf: str, work: str) -> str:
    return tables.land_topic(_event_rows(spark, sf), "event_id", f"{work}/topic")


def stream_source(spark: SparkSession, sf: str) -> DataFrame:
    """All records of a topic, decoded, in several batches."""
    work = scratch_path(spark, "source")
    raw = io.read_record_files(spark, _event_topic(spark, sf, work), max_per_trigger=8)
    io.drain(io.write_files(records.decode_records(raw), f"{work}/out", f"{work}/checkpoint"))
    return spark.read.parquet(f"{work}/out")


def stream_tail(spark: SparkSession, sf: str) -> DataFrame:
    """Offset, key and value of all records."""
    work = scratch_path(spark, "tail")
    raw = io.read_record_files(spark, _event_topic(spark, sf, work))
    io.drain(io.write_files(io.tail(raw), f"{work}/out", f"{work}/checkpoint"))
    return spark.read.parquet(f"{work}/out")


def stream_json_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Word counts of a stream as JSON values in text files, and back."""
    work = scratch_path(spark, "json-sink")
    topic = tables.land_topic(_items(spark, sf), "id", f"{work}/topic")
    counted = jobs.count_words(io.read_record_files(spark, topic)).select("id", "by", "wordCount")
    values = records.json_envelope(counted)
    io.drain(io.write_files(values, f"{work}/out", f"{work}/checkpoint", fmt="text"))
    return spark.read.schema("id bigint, by string, wordCount int").json(f"{work}/out")


def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Records of the documents, of which many are spoilt in some way, as a stream into items and faults."""
    work = scratch_path(spark, "quarantine")
    key, value = F.col("key").cast("string"), F.col("value").cast("string")
    spoilt = (
        F.when(F.col("offset") % 10 == 1, F.expr("left(value, cast(length(value) / 2 AS int))"))
        .when(F.col("offset") % 10 == 3, F.lit("null"))
        .when(F.col("offset") % 10 == 5, F.concat(F.lit('{"id":"x'), "key", F.lit('"}')))
        .when(F.col("offset") % 10 == 7, F.lit('{"type":"comment"}'))
        .when(F.col("offset") % 10 == 9, F.concat(F.lit("["), "key", F.lit("]")))
        .otherwise(F.col("value"))
    )
    topic = _document_topic(spark, sf).withColumns({"key": key, "value": value})
    written = topic.withColumns({"key": F.col("key").cast("binary"), "value": spoilt.cast("binary")})
    written.write.option("maxRecordsPerFile", 5000).parquet(f"{work}/topic")
    checked = records.check_items(io.read_record_files(spark, f"{work}/topic"), ITEM_COLUMNS)
    io.drain(io.write_checked(checked, f"{work}/out", f"{work}/checkpoint"))
    found = io.read_checked(spark, f"{work}/out", checked.schema)
    items = records.sound_items(found).select("key", *ITEM_COLUMNS)
    faults = records.faulty_records(found)
    return items.unionByName(faults, allowMissingColumns=True)


def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """A stream that is stopped and started from its checkpoint: views arrive first, the other
    events later, and a third run finds nothing new."""
    work = scratch_path(spark, "restart")
    events = _event_rows(spark, sf)
    arrivals = [events.where("event_type = 'view'"), events.where("NOT (event_type <=> 'view')"), None]
    for number, arrival in enumerate(arrivals):
        if arrival is not None:
            tables.land_topic(arrival, "event_id", f"{work}/topic/run={number}")
        raw = io.read_record_files(spark, f"{work}/topic/run=*")
        decoded = records.decode_records(raw)
        io.run_with_restarts(
            lambda rows=decoded: io.write_files(rows, f"{work}/out", f"{work}/checkpoint")
        )
    return spark.read.parquet(f"{work}/out")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        stream_source,
        stream_tail,
        archive_scan,
        frontier_delta,
        stream_frontier,
        stream_produce,
        backfill_range,
        backfill_archive,
        item_lookup,
        stream_json_sink,
        kv_encode,
        archive_upsert,
        archive_compact,
        archive_lookup,
        kv_decode,
        item_parse,
        item_text,
        item_normalize,
        drop_ghosts,
        progress_sample,
        json_envelope,
        json_field,
        json_compact,
        doc_assemble,
        sentences,
        nlp_tokens,
        ws_tokens,
        stop_words,
        word_count,
        hashing_tf,
        term_freq,
        idf,
        tf_idf,
        token_embeddings,
        doc_embeddings,
        sentence_embeddings,
        sentence_embeddings_pooled,
        sentiment,
        sentiment_logistic,
        keywords,
        annotate_items,
        fit_apply,
        stream_fit,
        annotate_stream,
        model_roundtrip,
        document_job,
        sentence_job,
        stream_restart,
        stream_quarantine,
    )
}
