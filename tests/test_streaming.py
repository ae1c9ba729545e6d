"""Streams give what batch gives, also over restarts."""

import json

import pytest
from pyspark.sql import functions as F

from quillstream.operators import ingest, records
from quillstream.plans import jobs
from quillstream.schema import RECORD
from quillstream.session import scratch_path
from quillstream.sources import frontier, tables
from quillstream.streaming import io


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def work(spark):
    return scratch_path(spark, "stream")


@pytest.fixture
def topic(spark, small, work):
    return tables.land_topic(tables.document_items(spark, small), "id", f"{work}/topic", rows_per_file=35)


def test_stream_equals_batch_and_restart_adds_nothing(spark, topic, work):
    batch = jobs.count_words(spark.read.parquet(topic))
    stream = jobs.count_words(io.read_record_files(spark, topic, max_per_trigger=2))
    for _ in range(2):
        query = io.drain(io.write_files(stream, f"{work}/out", f"{work}/checkpoint"))
        assert rows(spark.read.parquet(f"{work}/out")) == rows(batch)
    assert query.exception() is None


def test_sink_is_valid_json(spark, topic, work):
    values = records.json_envelope(jobs.count_words(io.read_record_files(spark, topic)))
    io.drain(io.write_files(values, f"{work}/out", f"{work}/checkpoint", fmt="text"))
    lines = [json.loads(r.value) for r in spark.read.text(f"{work}/out").collect()]
    assert len(lines) == 200 and set(lines[0]) == {"key", "id", "by", "time", "wordCount"}


def test_failed_run_resumes(spark, topic, work):
    """The first attempt dies in the middle; the second picks up at the checkpoint."""
    attempts = []

    def make():
        attempts.append(1)
        decoded = records.decode_records(io.read_record_files(spark, topic, max_per_trigger=2))
        if len(attempts) == 1:
            fail = F.when(F.col("key") == "150", F.raise_error(F.lit("boom"))).otherwise(F.col("value"))
            decoded = decoded.withColumn("value", fail)
        return io.write_files(decoded, f"{work}/out", f"{work}/checkpoint")

    io.run_with_restarts(make)
    assert len(attempts) == 2
    expected = records.decode_records(spark.read.parquet(topic))
    assert rows(spark.read.parquet(f"{work}/out")) == rows(expected)


def test_lasting_failure_is_raised(spark, topic, work):
    def make():
        boom = F.raise_error(F.lit("boom")).cast("string").alias("v")
        bad = io.read_record_files(spark, topic).select(boom)
        return io.write_files(bad, f"{work}/out", f"{work}/checkpoint")

    with pytest.raises(Exception, match="boom"):
        io.run_with_restarts(make, attempts=2)


def test_console_and_tail(spark, topic, work, capfd):
    tail = io.tail(io.read_record_files(spark, topic))
    io.drain(io.write_console(tail, f"{work}/checkpoint", shown=2))
    printed = capfd.readouterr().out
    assert "offset" in printed and "only showing top 2 rows" in printed


def test_progress(spark, topic, work):
    items = records.parse_items(io.read_record_files(spark, topic))
    query = io.drain(
        io.write_files(io.with_progress(items).select("id"), f"{work}/out", f"{work}/checkpoint")
    )
    seen = query.lastProgress["observedMetrics"]["progress"]
    assert (seen["rows"], seen["highest"]) == (200, 199)


def test_paced_query(spark, topic, work):
    decoded = records.decode_records(io.read_record_files(spark, topic))
    query = io.start_paced(io.write_files(decoded, f"{work}/out", f"{work}/checkpoint"), seconds=0)
    try:
        query.processAllAvailable()
        assert spark.read.parquet(f"{work}/out").count() == 200
    finally:
        query.stop()


def test_archive_upserts(spark, work):
    schema = "id bigint, seq int, text string"
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], schema).write.parquet(f"{work}/in/f=1")
    ingest.write_archive(spark.createDataFrame([(1, 0, "old"), (3, 0, "c")], schema), f"{work}/a", "seq")
    stream = spark.readStream.schema(schema).parquet(f"{work}/in/f=*")
    for seq in (1, 2):
        io.drain(io.write_archive_upserts(stream, f"{work}/a", f"{work}/checkpoint", "seq"))
        spark.createDataFrame([(2, 5, "b5")], schema).write.mode("overwrite").parquet(f"{work}/in/f=2")
    got = {r.id: r.text for r in ingest.read_archive(spark, f"{work}/a").collect()}
    assert got == {1: "a", 2: "b5", 3: "c"}


def test_produce_finds_items_that_land_while_it_runs(spark, work):
    def land(i):
        spark.createDataFrame([(i, f"t{i}")], "id bigint, text string").write.parquet(f"{work}/landed/i={i}")

    def announce(i):
        spark.createDataFrame([(i,)], "id bigint").write.mode("append").parquet(f"{work}/ids")

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{work}/out/batch={number}")

    land(1)
    announce(1)
    announce(2)
    ids = spark.readStream.schema("id bigint").parquet(f"{work}/ids")
    landed = lambda: spark.read.parquet(f"{work}/landed").drop("i")
    query = io.start_paced(jobs.write_produced(ids, landed, write, f"{work}/checkpoint"), 0)
    try:
        query.processAllAvailable()
        land(3)
        announce(3)
        query.processAllAvailable()
    finally:
        query.stop()
    got = {r.key: r.value for r in spark.read.parquet(f"{work}/out").collect()}
    assert got == {"1": '{"id":1,"text":"t1"}', "2": "null", "3": '{"id":3,"text":"t3"}'}


def publish(path, number):
    with open(path, "w") as file:
        file.write(f"{number}\n")


def test_frontier_survives_restart_and_never_goes_back(spark, work):
    import os

    os.makedirs(work)
    newest = f"{work}/newest"

    def poll(number):
        publish(newest, number)
        stream = frontier.frontier_stream(spark, newest, chunk=4)
        io.drain(io.write_files(stream, f"{work}/out", f"{work}/checkpoint"))
        return sorted(r.id for r in spark.read.schema("id bigint").parquet(f"{work}/out").collect())

    assert poll(100) == []
    assert poll(110) == list(range(101, 111))
    assert poll(90) == list(range(101, 111))
    assert poll(112) == list(range(101, 113))


def test_frontier_with_a_start(spark, work):
    import os

    os.makedirs(work)
    publish(f"{work}/newest", 5)
    stream = frontier.frontier_stream(spark, f"{work}/newest", start_id=2)
    io.drain(io.write_files(stream, f"{work}/out", f"{work}/checkpoint"))
    assert sorted(r.id for r in spark.read.parquet(f"{work}/out").collect()) == [3, 4, 5]


def test_a_wide_gap_starts_at_once_and_is_read_in_tasks(spark, work):
    import os
    import time

    os.makedirs(work)
    publish(f"{work}/newest", 20_000_000)
    stream = frontier.frontier_stream(spark, f"{work}/newest", start_id=0, tasks=8)
    query = io.drain(
        io.with_progress(stream).writeStream.format("noop").option("checkpointLocation", f"{work}/checkpoint")
    )
    seen = query.lastProgress["observedMetrics"]["progress"]
    assert (seen["rows"], seen["highest"]) == (20_000_000, 20_000_000)
    reader = frontier.FrontierReader({"path": f"{work}/newest", "startid": "0"})
    start = time.perf_counter()
    ranges = reader.partitions({"id": 0}, {"id": 10**12})
    first = next(reader.read(ranges[0]))
    assert len(ranges) == frontier.TASKS and first.num_rows == frontier.BATCH and time.perf_counter() - start < 1


def test_one_mark_file_is_read_at_a_poll(work, monkeypatch):
    import os

    os.makedirs(f"{work}/marks")
    for number in range(1, 6):
        publish(f"{work}/marks/{number}", 10 * number)
        os.utime(f"{work}/marks/{number}", ns=(number, number))
    read = []
    numbers = frontier._numbers
    monkeypatch.setattr(frontier, "_numbers", lambda fs, name: read.append(name) or numbers(fs, name))
    assert frontier.read_newest_id(f"{work}/marks") == 50 and read == [f"{work}/marks/5"]
    publish(f"{work}/marks/6", "")
    assert frontier.highest_mark(f"{work}/marks") == 50
    publish(f"{work}/marks/7", 45)
    assert frontier.highest_mark(f"{work}/marks") == 50 and frontier.highest_mark(f"{work}/marks") == 50
    publish(f"{work}/marks/8", 60)
    assert frontier.highest_mark(f"{work}/marks") == 60


def test_every_record_is_an_item_or_a_fault(spark, work):
    payloads = {
        "ok": '{"id":1,"text":"a","more":[1]}', "late": ' {"id": 2}', "null": "null", "none": None, "empty": "",
        "cut": '{"id":3,"text":"a', "type": '{"id":"x3"}', "score": '{"id":4,"score":"high"}', "noid": '{"text":"a"}',
        "list": "[1]", "word": "hello", "bytes": '{"id":5,"text":"\\ud800"}', "big": '{"id":99999999999999999999}',
    }
    rows_in = [(k.encode(), v and v.encode()) for k, v in payloads.items()]
    rows_in = [(k, v if payloads[k.decode()] != "" else b"") for k, v in rows_in]
    frame = spark.createDataFrame([(*r, "items", 0, n, None) for n, r in enumerate(rows_in)], RECORD)
    frame.repartition(3).write.parquet(f"{work}/topic")
    stream = records.check_items(io.read_record_files(spark, f"{work}/topic", max_per_trigger=1))
    for _ in range(2):
        io.drain(io.write_checked(stream, f"{work}/out", f"{work}/checkpoint"))
    found = io.read_checked(spark, f"{work}/out", stream.schema)
    items = {r.key: r for r in records.sound_items(found).collect()}
    faults = {r.key: r for r in records.faulty_records(found).collect()}
    assert {k: r.fault for k, r in faults.items()} == {
        "null": "missing", "none": "missing", "empty": "no-object", "cut": "malformed", "type": "field-type",
        "score": "field-type", "noid": "no-id", "list": "no-object", "word": "no-object", "big": "field-type",
    }
    assert set(items) | set(faults) == set(payloads) and len(items) + len(faults) == found.count() == len(payloads)
    assert items["ok"].id == 1 and items["late"].id == 2 and faults["cut"].value == payloads["cut"]
    batch = records.check_items(spark.read.parquet(f"{work}/topic"))
    assert rows(batch.select(*stream.columns)) == rows(found.select(*stream.columns))
    plan = records.sound_items(found)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PartitionFilters: [isnull(fault" in plan


def test_kafka_needs_its_connector(spark):
    """The options are accepted; without the connector's jar Spark says what is missing."""
    with pytest.raises(Exception, match="(?i)kafka"):
        io.read_kafka(spark, "localhost:9092", "items", max_per_trigger=10)
