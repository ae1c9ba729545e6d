"""The two annotation jobs: one result row per item, from records to annotated rows.

Models are trained in batch on past items and saved; the jobs only apply them, so every job is a
narrow projection that runs on a stream without state and without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from quillstream.functions.records import item_key
from quillstream.functions.text import word_count
from quillstream.operators import classify, embed, ingest, records
from quillstream.operators.stages import (
    DocumentStage,
    EmbeddingStage,
    KeywordStage,
    SentenceStage,
    SentimentStage,
    TokenStage,
    WordCountStage,
)


@dataclass(frozen=True)
class Models:
    """Paths of the trained models: word vectors, a classifier on them, and word vectors of another
    kind for the second embedding of sentences."""

    vectors: str
    classifier: str
    second: str


def train_models(
    items: DataFrame,
    labels: DataFrame,
    folder: str,
    size: int = 128,
    window: int = 2,
    second_window: int = 1,
) -> Models:
    """Train both kinds of word vectors on the item texts, from wider and narrower windows, and a
    classifier on the items that have a label. ``labels`` holds id and label (0 or 1)."""
    vectors = embed.fit_vectors(items, f"{folder}/vectors", size, window)
    second = embed.fit_vectors(items, f"{folder}/second", size, second_window)
    rows = labelled_vectors(items, labels, vectors)
    classifier = classify.fit_classifier(rows, labels, f"{folder}/classifier")
    return Models(vectors, classifier, second)


# Ids of labelled items that are broadcast at most (some 60 MB).
BROADCAST_IDS = 2_000_000


def labelled_vectors(items: DataFrame, labels: DataFrame, vectors: str) -> DataFrame:
    """id and embedding of the items that have a label. No text is shuffled for it: the ids go to the texts, and
    where there are too many of them, all items get their vectors, which meet the labels in the fit."""
    texts, wanted = items.select("id", "text"), labels.select("id").distinct()
    if wanted.count() <= BROADCAST_IDS:
        texts = texts.join(F.broadcast(wanted), "id", "left_semi")
    return embed.mean_vectors(texts, vectors).drop("text")


def text_stages() -> list:
    """Document, sentences, both kinds of tokens, hashed term frequency and word count: the stages
    that need no trained model."""
    return [
        DocumentStage(inputCol="text", outputCol="document"),
        SentenceStage(inputCol="document", outputCol="sentence"),
        Tokenizer(inputCol="text", outputCol="tokens"),
        TokenStage(inputCol="sentence", outputCol="token"),
        HashingTF(inputCol="tokens", outputCol="raw_tf"),
        WordCountStage(inputCol="token", outputCol="wordCount"),
    ]


def document_stages(models: Models, threshold: float = 0.7) -> list:
    """Text stages, an embedding and a sentiment per document, and an embedding per token."""
    return [
        *text_stages(),
        EmbeddingStage(
            inputCol="document", outputCol="sentence_embeddings", modelPath=models.vectors
        ),
        SentimentStage(
            inputCol="sentence_embeddings",
            outputCol="sentiment",
            modelPath=models.classifier,
            threshold=threshold,
        ),
        EmbeddingStage(
            inputCol="token",
            outputCol="bert_embeddings",
            modelPath=models.vectors,
            annotatorType="word_embeddings",
        ),
    ]


def sentence_stages(
    models: Models,
    threshold: float = classify.DEFAULT_THRESHOLD,
    token_units: str = "sentence",
) -> list:
    """Two embeddings and a sentiment per sentence, and keywords per document. The tokens come from
    the sentences, so that no keyword crosses one, or from the whole document."""
    return [
        DocumentStage(inputCol="text", outputCol="document"),
        SentenceStage(inputCol="document", outputCol="sentence"),
        TokenStage(inputCol=token_units, outputCol="token"),
        EmbeddingStage(
            inputCol="sentence",
            outputCol="bert_sentence_embeddings",
            modelPath=models.second,
        ),
        EmbeddingStage(
            inputCol="sentence", outputCol="sentence_embeddings", modelPath=models.vectors
        ),
        SentimentStage(
            inputCol="sentence_embeddings",
            outputCol="sentiment",
            modelPath=models.classifier,
            threshold=threshold,
        ),
        KeywordStage(inputCol="token", outputCol="keywords"),
    ]


def produce_records(ids: DataFrame, landed: DataFrame, sequence: str | None = None) -> DataFrame:
    """New ids to records: the item's JSON, or ``null`` for an id that has no item (yet)."""
    found = ingest.item_lookup(ids, landed.withColumn("_found", F.lit(True)), sequence)
    payload = F.to_json(F.struct(*[c for c in found.columns if c != "_found"]))
    value = F.when(F.col("_found"), payload).otherwise("null")
    return found.select(item_key(F.col("id")).alias("key"), value.alias("value"))


def write_produced(
    ids: DataFrame,
    landed: Callable[[], DataFrame],
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    sequence: str | None = None,
) -> DataStreamWriter:
    """Produce records of a stream of ids, batch by batch. ``landed`` opens the items anew for every
    batch, so an item that landed after the stream was started is found; only the items of the
    batch's ids go into the lookup. ``write`` gets the records and the number of the batch, which
    stays the same when a batch runs again after a failure."""

    def produce(batch: DataFrame, number: int) -> None:
        items = landed().join(batch.select("id"), "id", "left_semi")
        write(produce_records(batch, items, sequence), number)

    return (
        ids.writeStream.outputMode("append")
        .foreachBatch(produce)
        .option("checkpointLocation", checkpoint)
    )


def backfill(
    spark: SparkSession, highest_id: int, landed: DataFrame, path: str, sequence: str
) -> None:
    """All items from the highest id down to 1 into an archive; ids without an item are left out. An item
    without a sequence is an item too, older than any other version of it."""
    known = landed.withColumn("_found", F.lit(True))
    found = ingest.item_lookup(ingest.backfill_ids(spark, highest_id), known, sequence)
    ingest.write_archive(found.where("_found").drop("_found"), path, sequence)


def compose(stages: list, items: DataFrame) -> PipelineModel:
    """The stages as one fitted model. Fit it on past items, never on a stream."""
    return Pipeline(stages=stages).fit(items)


def prepare(raw: DataFrame, text_fill: str = "", keep_ghosts: bool = True) -> DataFrame:
    """Records to id and text: decode, parse, fill, project."""
    items = records.parse_items(raw, ["id", "text"])
    if not keep_ghosts:
        items = records.drop_ghosts(items)
    return records.item_text(records.normalize_items(items, text_fill))


def annotate_documents(
    raw: DataFrame, fitted: PipelineModel, text_fill: str = "", keep_ghosts: bool = True
) -> DataFrame:
    """Records to JSON values of fully annotated items."""
    return records.json_envelope(fitted.transform(prepare(raw, text_fill, keep_ghosts)))


def annotate_sentences(
    raw: DataFrame, fitted: PipelineModel, text_fill: str = ".", keep_ghosts: bool = True
) -> DataFrame:
    """Records to rows annotated per sentence, with keywords."""
    return fitted.transform(prepare(raw, text_fill, keep_ghosts))


def count_words(raw: DataFrame) -> DataFrame:
    """Records to normalized items with their word count: the main job without models."""
    items = records.normalize_items(records.parse_items(raw, ["id", "by", "time", "text"]))
    return items.select("key", "id", "by", "time", word_count(F.col("text")).alias("wordCount"))
