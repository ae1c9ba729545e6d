"""Frontier, lookup, archive."""

import os

import pytest
from pyspark.sql import functions as F

from quillstream.operators import ingest
from quillstream.plans import jobs
from quillstream.session import scratch_path
from quillstream.sources import archive, frontier, snapshots, tables


def ids(df):
    return [r.id for r in df.collect()]


@pytest.mark.parametrize(
    "last, newest, expected, mark",
    [
        (None, 5, [], 5),
        (5, 5, [], 5),
        (5, 8, [6, 7, 8], 8),
        (8, 3, [], 8),
        (3_000_000_000, 3_000_000_002, [3_000_000_001, 3_000_000_002], 3_000_000_002),
    ],
)
def test_frontier(spark, last, newest, expected, mark):
    assert ids(ingest.frontier_delta(spark, last, newest)) == expected
    assert ingest.next_mark(last, newest) == mark


def test_id_ranges():
    assert frontier.id_ranges(0, 7, 3) == [(1, 3), (4, 6), (7, 7)]
    assert frontier.id_ranges(7, 7, 3) == frontier.id_ranges(9, 7, 3) == []
    wide = frontier.id_ranges(5, 10**9 + 5, 100, tasks=64)
    assert len(wide) == 64 and wide[0][0] == 6 and wide[-1][1] == 10**9 + 5
    assert all(a[1] + 1 == b[0] for a, b in zip(wide, wide[1:], strict=False))


def test_backfill_and_progress(spark):
    down = ingest.backfill_ids(spark, 2500)
    assert ids(down) == list(range(2500, 0, -1))
    assert ids(ingest.progress_sample(down)) == [2000, 1000]
    assert ids(ingest.backfill_ids(spark, 0)) == []


def test_lookup(spark):
    landed = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id bigint, text string, seq int"
    )
    wanted = spark.createDataFrame([(1,), (1,), (2,), (9,)], "id bigint")
    found = ingest.item_lookup(wanted, landed, "seq")
    assert {(r.id, r.text) for r in found.collect()} == {(1, "b"), (2, "c"), (9, None)}
    assert found.count() == 3


def test_lookup_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        landed = spark.range(100).select("id", F.lit("x").alias("text"))
        found = ingest.item_lookup(spark.range(50).union(spark.range(50)), landed)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_row_of_a_hot_key(spark):
    """Half of all rows share one id; ties are settled the same way in any order."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("id"),
        (F.col("id") % 100).alias("seq"),
        F.col("id").cast("string").alias("text"),
    )
    one = {r.id: (r.seq, r.text) for r in ingest.latest_rows(rows, "id", "seq").collect()}
    other = ingest.latest_rows(rows.orderBy(F.desc("text")).repartition(7), "id", "seq")
    assert one == {r.id: (r.seq, r.text) for r in other.collect()}
    assert len(one) == 10_001 and one[0][0] == 98
    plan = ingest.latest_rows(rows, "id", "seq")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_upsert_touches_only_its_blocks(spark):
    path = scratch_path(spark, "archive")
    schema = "id bigint, seq int, text string"
    first = spark.createDataFrame([(i, 1, f"v1-{i}") for i in range(40)], schema)
    ingest.write_archive(first, path, "seq", block=10)

    def files():
        return {
            os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path)
            for f in names
            if f.endswith(".parquet")
        }

    before = files()
    updates = spark.createDataFrame(
        [(3, 2, "v2-3"), (4, 0, "too old"), (55, 1, "new")], schema
    )
    for _ in range(2):
        ingest.upsert_archive(updates, path, "seq", block=10)
        rows = {r.id: r.text for r in ingest.read_archive(spark, path).collect()}
        expected = {i: f"v1-{i}" for i in range(40)} | {3: "v2-3", 55: "new"}
        assert rows == expected
    after = files()
    kept = {f for f in before if "block=0" not in f}
    assert kept <= set(after) and all(after[f] == before[f] for f in kept)


def test_upsert_that_breaks_off_loses_nothing(spark):
    path = scratch_path(spark, "archive")
    schema = "id bigint, seq int, text string"
    first = spark.createDataFrame([(i, 1, f"v1-{i}") for i in range(20)], schema)
    ingest.write_archive(first, path, "seq", block=10)
    updates = spark.createDataFrame([(i, 2, f"v2-{i}") for i in range(20)], schema)
    text = F.when(F.col("id") == 17, F.raise_error(F.lit("boom"))).otherwise(F.col("text"))
    with pytest.raises(Exception, match="boom"):
        ingest.upsert_archive(updates.withColumn("text", text), path, "seq", block=10)
    # As if the driver had died when it had published one block of two.
    ingest.upsert_archive(updates.filter("id < 10"), path, "seq", block=10)
    half = {i: f"v{1 + (i < 10)}-{i}" for i in range(20)}
    assert {r.id: r.text for r in ingest.read_archive(spark, path).collect()} == half
    ingest.upsert_archive(updates, path, "seq", block=10)
    done = {i: f"v2-{i}" for i in range(20)}
    assert {r.id: r.text for r in ingest.read_archive(spark, path).collect()} == done
    compact = scratch_path(spark, "archive")
    ingest.compact_archive(spark, path, compact, "seq", block=10)
    assert {r.id: r.text for r in ingest.read_archive(spark, compact).collect()} == done
    assert spark.read.parquet(compact).count() == 20


def test_upsert_without_an_id_keeps_the_higher_sequence(spark):
    path = scratch_path(spark, "archive")
    schema = "id bigint, seq int, text string"
    ingest.write_archive(spark.createDataFrame([(None, 9, "new"), (1, 1, "a")], schema), path, "seq")
    ingest.upsert_archive(spark.createDataFrame([(None, 1, "old")], schema), path, "seq")
    got = {r.id: (r.seq, r.text) for r in ingest.read_archive(spark, path).collect()}
    assert got == {None: (9, "new"), 1: (1, "a")}


def test_json_archive(spark):
    path = scratch_path(spark, "json")
    items = spark.createDataFrame([(1, "a\n<p>b", None), (2, None, 3)], "id bigint, text string, score int")
    archive.write_json_archive(items, path)
    back = {r.id: (r.text, r.score, r.kids) for r in archive.scan_json_archive(spark, path).collect()}
    assert back == {1: ("a\n<p>b", None, None), 2: (None, 3, None)}


def test_table_items_have_the_item_schema(spark, small):
    from quillstream.schema import ITEM

    rows = tables.to_item_schema(tables.document_items(spark, small))
    assert [f.dataType for f in rows.schema] == [f.dataType for f in ITEM]


ROW = "id bigint, seq int, text string"


def contents(spark, path):
    return {r.id: r.text for r in ingest.read_archive(spark, path).collect()}


@pytest.fixture
def archived(spark):
    """An archive of ids 0 to 39, of which 3 (twice) and 15 have newer versions in deltas."""
    path = scratch_path(spark, "archive")
    ingest.write_archive(spark.createDataFrame([(i, 1, f"v1-{i}") for i in range(40)], ROW), path, "seq", block=10)
    for seq in (3, 2):
        ingest.upsert_archive(spark.createDataFrame([(i, seq, f"v{seq}-{i}") for i in (3, 15)], ROW), path, "seq")
    return path


NEWER = {i: f"v1-{i}" for i in range(40)} | {3: "v3-3", 15: "v3-15"}


def test_compaction_of_touched_blocks(spark, archived):
    before = snapshots.Store(spark, archived).current()
    assert set(before.deltas) == {"0", "1"} and contents(spark, archived) == NEWER
    assert ingest.compact_blocks(spark, archived, min_deltas=3) == []
    assert sorted(ingest.compact_blocks(spark, archived)) == ["0", "1"]
    after = snapshots.Store(spark, archived).current()
    assert not after.deltas and all(after.base[b] == before.base[b] for b in ("2", "3"))
    assert contents(spark, archived) == NEWER
    plan = ingest.read_archive(spark, archived)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_only_blocks_with_deltas_are_reconciled_and_without_text(spark, archived):
    plan = ingest.read_archive(spark, archived)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "Broadcast" in exchanges[0] and "text" not in exchanges[0]


def test_a_write_that_breaks_off_is_not_seen(spark, archived, monkeypatch):
    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(snapshots.Store, "publish", die)
        with pytest.raises(KeyboardInterrupt):
            ingest.upsert_archive(spark.createDataFrame([(i, 9, "lost") for i in range(40)], ROW), archived, "seq")
        with pytest.raises(KeyboardInterrupt):
            ingest.compact_blocks(spark, archived)
    assert contents(spark, archived) == NEWER
    assert len(ingest.expire_archive(spark, archived, keep=1, older_than=0)) == 2
    assert contents(spark, archived) == NEWER
    assert ingest.expire_archive(spark, archived, keep=1) == []


def test_writers_at_the_same_time(spark, archived, monkeypatch):
    """While a compaction is at work, an update lands: both are kept. Two compactions: the second gives up."""
    publish = snapshots.Store.publish
    calls = []

    def late(store, manifest):
        if not calls:
            calls.append(1)
            ingest.upsert_archive(spark.createDataFrame([(3, 7, "v7-3"), (70, 1, "new")], ROW), archived, "seq")
        publish(store, manifest)

    monkeypatch.setattr(snapshots.Store, "publish", late)
    ingest.compact_blocks(spark, archived)
    assert contents(spark, archived) == NEWER | {3: "v7-3", 70: "new"}
    store, now = snapshots.open_store(spark, archived)
    assert set(now.deltas) == {"0"} and len(now.deltas["0"]) == 1
    merged = {"0": [now.base["0"], *now.deltas["0"]]}
    store.commit(lambda m: m.compacted("f1", merged))
    with pytest.raises(snapshots.Conflict):
        store.commit(lambda m: m.compacted("f2", merged))


def test_archive_lookup(spark, archived):
    ids = spark.createDataFrame([(3,), (3,), (15,), (22,), (99,), (None,)], "id bigint")
    for pushed in (1000, 1):
        found = ingest.archive_lookup(ids, archived, pushed)
        assert sorted((r.id or -1, r.text) for r in found.collect()) == [
            (-1, None), (3, "v3-3"), (15, "v3-15"), (22, "v1-22"), (99, None),
        ]
    assert found.columns == ["id", "seq", "text"]


def test_archive_lookup_reads_only_what_it_needs(spark):
    path = scratch_path(spark, "archive")
    rows = spark.range(200_000).select("id", F.lit(1).alias("seq"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    ingest.write_archive(rows, path, "seq", block=50_000)
    ids = spark.createDataFrame([(7,), (60_001,), (60_002,), (99_999,), (10**9,)], "id bigint")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = ingest.archive_lookup(ids, path)
        executed = found._jdf.queryExecution()
        assert executed.executedPlan().executeCollect()
        leaves = executed.executedPlan().collectLeaves()
        scans = [leaves.apply(k) for k in range(leaves.size()) if "parquet" in leaves.apply(k).nodeName()]
        assert "In(id" in scans[0].toString()
        # Of four blocks two are opened, and of these the pages that one of the ids can be in.
        assert {f.split("block=")[1].split("/")[0] for f in found.inputFiles()} == {"0", "1"}
        assert scans[0].metrics().apply("numOutputRows").value() <= 60_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert {r.id for r in found.collect() if r.text} == {7, 60_001, 60_002, 99_999}


def test_backfill_keeps_items_without_a_time(spark):
    landed = spark.createDataFrame([(1, "a", None), (2, "b", None), (2, "older", 5), (3, "c", 7)], "id bigint, text string, time bigint")
    path = scratch_path(spark, "archive")
    jobs.backfill(spark, 4, landed, path, "time")
    assert contents(spark, path) == {1: "a", 2: "older", 3: "c"}
