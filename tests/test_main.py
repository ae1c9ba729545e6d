"""The command line: train, then run a job over files."""

import json

from pyspark.sql import functions as F

from quillstream.operators import ingest
from quillstream.plans import main
from quillstream.session import scratch_path
from quillstream.sources import tables


def test_train_and_run(spark, small, capfd):
    work = scratch_path(spark, "main")
    items = tables.document_items(spark, small)
    items.write.parquet(f"{work}/items")
    tables.read_table(spark, small, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label")
    ).write.parquet(f"{work}/labels")
    tables.land_topic(items, "id", f"{work}/topic")
    main.run(
        spark,
        f"train --items {work}/items --labels {work}/labels --models {work}/models --size 4".split(),
    )
    common = f"--models {work}/models --source {work}/topic --source-format parquet --drain"
    main.run(
        spark,
        f"document {common} --sink {work}/out --sink-format text --checkpoint {work}/c1".split(),
    )
    lines = [json.loads(r.value) for r in spark.read.text(f"{work}/out").collect()]
    assert len(lines) == 200
    assert all(len(x["token"]) == x["wordCount"] for x in lines)
    main.run(spark, f"sentence {common} --checkpoint {work}/c2 --fill x --drop-ghosts".split())
    assert "keywords" in capfd.readouterr().out


def test_produce_tail_and_backfill(spark, small, capfd):
    work = scratch_path(spark, "main")
    items = tables.document_items(spark, small)
    items.write.parquet(f"{work}/items")
    spark.range(1).select(F.lit("209").alias("value")).write.text(f"{work}/newest")
    main.run(
        spark,
        f"produce --newest {work}/newest --start-id -1 --items {work}/items --sink {work}/records "
        f"--sink-format parquet --checkpoint {work}/c1 --drain".split(),
    )
    records = {r.key: r.value for r in spark.read.parquet(f"{work}/records").collect()}
    assert len(records) == 210 and records["205"] == "null"
    assert json.loads(records["7"])["id"] == 7
    tables.land_topic(items, "id", f"{work}/topic", rows_per_file=150)
    main.run(
        spark,
        f"tail --source {work}/topic --source-format parquet --checkpoint {work}/c2 --sink {work}/seen "
        "--sink-format parquet --at-once 1 --drain".split(),
    )
    assert spark.read.parquet(f"{work}/seen").select("offset").distinct().count() == 200
    main.run(
        spark, f"backfill --items {work}/items --highest 150 --archive {work}/archive".split()
    )
    assert ingest.read_archive(spark, f"{work}/archive").count() == 150
