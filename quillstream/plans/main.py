"""Produce and read records, train the models and run the annotation jobs from the command line.

    spark-submit quillstream/plans/main.py backfill --items PATH --highest ID --archive FOLDER
    spark-submit quillstream/plans/main.py produce --newest PATH --items PATH --sink TOPIC \\
        --servers HOST:PORT --checkpoint FOLDER
    spark-submit quillstream/plans/main.py tail --source TOPIC --servers HOST:PORT --checkpoint FOLDER
    spark-submit quillstream/plans/main.py train --items PATH --labels PATH --models FOLDER
    spark-submit quillstream/plans/main.py document --models FOLDER --source TOPIC --sink TOPIC \\
        --servers HOST:PORT --checkpoint FOLDER

Formats other than kafka read and write folders instead of topics. All folders must be visible to
every executor.
"""

from __future__ import annotations

import argparse

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from quillstream.operators.classify import DEFAULT_THRESHOLD
from quillstream.plans import jobs
from quillstream.session import build_session
from quillstream.sources import frontier
from quillstream.streaming import io


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    """Train on parquet tables of items (id, text) and labels (id, label), and save both jobs."""
    items = spark.read.parquet(args.items).select("id", "text")
    labels = spark.read.parquet(args.labels).select("id", "label")
    models = jobs.train_models(
        items, labels, args.models, args.size, args.window, args.second_window
    )
    for name, stages in (
        ("document", jobs.document_stages(models, args.document_threshold)),
        ("sentence", jobs.sentence_stages(models, args.sentence_threshold, args.token_units)),
    ):
        jobs.compose(stages, items).write().overwrite().save(f"{args.models}/{name}")


def source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.source_format == "kafka":
        return io.read_kafka(spark, args.servers, args.source, args.starting_offsets, args.at_once)
    return io.read_record_files(spark, args.source, args.source_format, args.at_once)


def sink(rows: DataFrame, args: argparse.Namespace) -> DataStreamWriter:
    if args.sink_format == "kafka":
        return io.write_kafka(rows, args.servers, args.sink, args.checkpoint)
    if args.sink_format == "console":
        return io.write_console(rows, args.checkpoint)
    return io.write_files(rows, args.sink, args.checkpoint, args.sink_format)


def start(writer: DataStreamWriter, args: argparse.Namespace) -> None:
    if args.drain:
        io.drain(writer)
    else:
        io.start_paced(writer, args.pace).awaitTermination()


def annotate(spark: SparkSession, args: argparse.Namespace) -> None:
    fitted = PipelineModel.load(f"{args.models}/{args.job}")
    job = jobs.annotate_documents if args.job == "document" else jobs.annotate_sentences
    rows = job(source(spark, args), fitted, args.fill, not args.drop_ghosts)
    start(sink(rows, args), args)


def tail(spark: SparkSession, args: argparse.Namespace) -> None:
    """Show (or write) every record of a topic."""
    start(sink(io.tail(source(spark, args)), args), args)


def produce(spark: SparkSession, args: argparse.Namespace) -> None:
    """Records of new ids. Kafka may get a batch twice after a failure; a folder gets each once."""

    def write(batch: DataFrame, number: int) -> None:
        if args.sink_format == "kafka":
            to_kafka = batch.write.format("kafka").option("kafka.bootstrap.servers", args.servers)
            to_kafka.option("topic", args.sink).save()
        else:
            folder = f"{args.sink}/batch={number}"
            batch.write.format(args.sink_format).mode("overwrite").save(folder)

    ids = frontier.frontier_stream(spark, args.newest, args.start_id)
    opened = lambda: spark.read.format(args.items_format).load(args.items)
    start(jobs.write_produced(ids, opened, write, args.checkpoint, args.sequence), args)


def backfill(spark: SparkSession, args: argparse.Namespace) -> None:
    items = spark.read.format(args.items_format).load(args.items)
    jobs.backfill(spark, args.highest, items, args.archive, args.sequence)


JOBS = {
    "train": train,
    "document": annotate,
    "sentence": annotate,
    "tail": tail,
    "produce": produce,
    "backfill": backfill,
}


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = main.add_subparsers(dest="job", required=True)
    fit = commands.add_parser("train", help="train and save the models")
    fit.add_argument("--items", required=True)
    fit.add_argument("--labels", required=True)
    fit.add_argument("--models", required=True)
    fit.add_argument("--size", type=int, default=128, help="vector size")
    fit.add_argument("--window", type=int, default=2, help="neighbours on each side of a word")
    fit.add_argument("--second-window", type=int, default=1, help="the same for the second encoder")
    fit.add_argument("--document-threshold", type=float, default=0.7)
    fit.add_argument("--sentence-threshold", type=float, default=DEFAULT_THRESHOLD)
    fit.add_argument("--token-units", choices=("sentence", "document"), default="sentence")

    def streaming(name: str, text: str, format_: str, reads: bool = True) -> argparse.ArgumentParser:
        command = commands.add_parser(name, help=text)
        if reads:
            command.add_argument("--source", required=True, help="topic or folder")
            command.add_argument("--source-format", default="kafka")
            command.add_argument("--starting-offsets", default="latest")
            command.add_argument("--at-once", type=int, help="records (kafka) or files per batch")
        command.add_argument("--sink", help="topic or folder")
        command.add_argument("--sink-format", default=format_)
        command.add_argument("--servers", default="localhost:9092")
        command.add_argument("--checkpoint", required=True)
        command.add_argument("--pace", type=int, default=0, help="seconds between batches")
        command.add_argument("--drain", action="store_true", help="stop when all input is processed")
        return command

    def lands(command: argparse.ArgumentParser, sequence: str | None) -> None:
        command.add_argument("--items", required=True, help="the items that have landed")
        command.add_argument("--items-format", default="parquet")
        command.add_argument("--sequence", default=sequence, help="column that orders versions")

    for name, format_, fill in (("document", "kafka", ""), ("sentence", "console", ".")):
        run_ = streaming(name, f"annotate per {name}", format_)
        run_.add_argument("--models", required=True)
        run_.add_argument("--fill", default=fill, help="text of an item that has none")
        run_.add_argument("--drop-ghosts", action="store_true", help="leave out records of no item")
    streaming("tail", "show the records of a topic", "console")
    new = streaming("produce", "records of new ids", "kafka", reads=False)
    new.add_argument("--newest", required=True, help="where the newest id is")
    new.add_argument("--start-id", type=int, help="mark of the first run; else what is newest then")
    lands(new, None)
    fill_in = commands.add_parser("backfill", help="all items up to an id, into an archive")
    fill_in.add_argument("--highest", type=int, required=True)
    fill_in.add_argument("--archive", required=True)
    lands(fill_in, "time")
    return main


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    JOBS[args.job](spark, args)


if __name__ == "__main__":
    run(build_session("quillstream"))
