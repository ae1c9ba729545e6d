"""Streaming sources and sinks with the format as a parameter, and running them to completion.

``kafka`` needs Spark's connector on the class path. The file formats read and write the same record
columns, so a job moves between them by its options alone.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from quillstream.operators.ingest import upsert_archive
from quillstream.schema import RECORD

# Zstandard for lines of text, as a value of ``compression``: Spark has no short name for it, but the codec of its
# parquet, which is the same whatever it writes. Annotated items take less than half the bytes of lz4.
ZSTD_LINES = "org.apache.parquet.hadoop.codec.ZstandardCodec"


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Records of a topic. ``latest`` skips what is there at the first start; afterwards the
    checkpoint decides."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def read_record_files(
    spark: SparkSession, path: str, fmt: str = "parquet", max_per_trigger: int | None = None
) -> DataFrame:
    """Records from files that arrive in a folder; ``max_per_trigger`` counts files."""
    reader = spark.readStream.format(fmt).schema(RECORD)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.load(path)


def tail(records: DataFrame) -> DataFrame:
    """Offset, key and value of every record, as text."""
    return records.select(
        "offset", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def with_progress(rows: DataFrame, name: str = "progress", key: str = "id") -> DataFrame:
    """Counts rows and the highest key of each batch on the side; a stream reports them in
    ``lastProgress["observedMetrics"]``, a batch job through an Observation of that name."""
    return rows.observe(name, F.count(F.lit(1)).alias("rows"), F.max(key).alias("highest"))


def write_files(
    rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"
) -> DataStreamWriter:
    """Append every batch to a folder, exactly once."""
    return (
        rows.writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def write_batches(
    rows: DataFrame, change: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> DataStreamWriter:
    """Write what a function makes of every batch to a folder of its own, exactly once: a batch that runs again
    replaces its folder. For work that has to look at a batch before it is planned."""

    def write(batch: DataFrame, number: int) -> None:
        change(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rows.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)


def write_checked(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append checked records to a folder, items and quarantined records apart, in one commit: each record is in
    exactly one of the two, exactly once. Reading either opens only its own files (``read_checked``)."""
    return write_files(rows, path, checkpoint).partitionBy("fault")


def read_checked(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What ``write_checked`` wrote; ``schema`` is that of the rows written."""
    return spark.read.schema(schema).parquet(path)


def write_kafka(
    rows: DataFrame, servers: str, topic: str, checkpoint: str, **options: str
) -> DataStreamWriter:
    """Send the value column (and key, if there is one) to a topic, at least once."""
    return (
        rows.writeStream.outputMode("append")
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )


def write_console(rows: DataFrame, checkpoint: str | None = None, shown: int = 20) -> DataStreamWriter:
    """Print the first rows of every batch. Spark's own console format brings each whole batch to
    the driver before it prints as many; this fetches only what it shows."""
    writer = rows.writeStream.outputMode("append").foreachBatch(
        lambda batch, _: batch.show(shown, truncate=False)
    )
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer


def write_archive_upserts(
    rows: DataFrame, path: str, checkpoint: str, sequence: str
) -> DataStreamWriter:
    """Merge every batch into an archive. A batch that runs again after a failure changes nothing,
    since the highest sequence wins."""
    return (
        rows.writeStream.outputMode("append")
        .foreachBatch(lambda batch, _: upsert_archive(batch, path, sequence))
        .option("checkpointLocation", checkpoint)
    )


def start_paced(writer: DataStreamWriter, seconds: int = 15) -> StreamingQuery:
    """Start with a batch at most every so many seconds; 0 runs batches back to back."""
    return writer.trigger(processingTime=f"{seconds} seconds").start()


# A session's settings for streams of annotated items. The file sink hands a writer's options to its codecs in part
# only, so the level of Zstandard comes from the session. Whole rows, a hundred times their text, wait beside a batch
# until Python is done with it, on disk where they don't fit in memory: so batches are of fewer rows.
ANNOTATED = {
    "parquet.compression.codec.zstd.level": "6",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "200",
}


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the streams that are started inside."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything that is there now, however long it takes, then stop. Raises what the query
    raised."""
    query = writer.trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return query


def run_with_restarts(make: Callable[[], DataStreamWriter], attempts: int = 3) -> StreamingQuery:
    """Drain a stream, starting again from its checkpoint if a run fails."""
    for attempt in range(attempts):
        try:
            return drain(make())
        except Exception:
            if attempt + 1 == attempts:
                raise
    raise ValueError("attempts must be positive")
