"""Finding ids to fetch, looking items up, and keeping the latest version of each item."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.session import scratch_path
from quillstream.sources import snapshots

BLOCK = 1_000_000
# Ids of a lookup that go into the scan one by one.
PUSHED_IDS = 1000
# The column by which an archive tells the versions of an item apart.
VERSION = "_version"


def frontier_delta(spark: SparkSession, last_id: int | None, newest_id: int) -> DataFrame:
    """Ids in (last_id, newest_id], ascending. Without a last id (the first poll) there are none:
    that poll only sets the mark. A newest id below the mark gives none either."""
    if last_id is None:
        return spark.range(0)
    return spark.range(last_id + 1, max(last_id, newest_id) + 1)


def next_mark(last_id: int | None, newest_id: int) -> int:
    """The mark after a poll. It never goes back, so no id is emitted twice."""
    return newest_id if last_id is None else max(last_id, newest_id)


def backfill_ids(spark: SparkSession, highest_id: int) -> DataFrame:
    """Ids from the highest down to 1, made in parallel on the executors."""
    return spark.range(highest_id, 0, -1)


def progress_sample(ids: DataFrame, every: int = 1000) -> DataFrame:
    """The ids at which a backfill reports progress: every 1000th, by its value. On streams use
    ``quillstream.streaming.io.with_progress``, which needs no second pass."""
    return ids.where(F.col("id") % every == 0)


def latest_rows(rows: DataFrame, key: str, sequence: str | None = None) -> DataFrame:
    """One row per key, the one with the highest sequence (last write wins).

    The aggregate keeps one row per key and map task, so a key with very many versions reaches the
    shuffle as one row per task. Equal sequences are settled by a content hash: a retried task
    picks the same row.
    """
    return _newest(rows, key, _version(rows, sequence), rows.columns)


def _version(rows: DataFrame, sequence: str | None) -> Column:
    content = F.xxhash64(*[F.col(c) for c in rows.columns])
    return F.struct(F.col(sequence), content.alias("content")) if sequence else content


def _newest(rows: DataFrame, key: str, order: Column, columns: list[str]) -> DataFrame:
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_row"))
    # The key comes from the grouping, so a join on it reuses the grouping's partitions.
    return newest.select(*[F.col(c if c == key else f"_row.{c}") for c in columns])


def item_lookup(ids: DataFrame, items: DataFrame, sequence: str | None = None) -> DataFrame:
    """One row per distinct id with the item's columns; all NULL but the id where there is none.

    Both sides are brought to one row per id before they meet, so no id can be heavy in the join.
    A stream of ids comes from the frontier, which gives every id once.
    """
    landed = latest_rows(items, "id", sequence)
    wanted = ids.select("id")
    return (wanted if ids.isStreaming else wanted.distinct()).join(landed, "id", "left")


def _block(id_column: Column, block: int) -> Column:
    return F.floor(id_column / block).cast("long")


def write_archive(rows: DataFrame, path: str, sequence: str, block: int = BLOCK) -> None:
    """Add the latest version of every given item to an archive, partitioned by id block. Files that
    are there are neither read nor changed. A new block's rows become its base, those of others a delta.

    The rows become visible all at once, when a manifest names them (see ``snapshots``), so a write that
    breaks off changes nothing, and running it again changes no result. Range partitioning keeps a block in few
    files and splits a large one over tasks; within files the rows are sorted, so an id lookup reads few row groups.
    """
    latest = latest_rows(rows, "id", sequence)
    store = snapshots.Store(rows.sparkSession, path)
    now = store.current()
    if now is not None:
        block = now.block
    stored = latest.withColumn(VERSION, _version(latest, sequence))
    folder = _write_folder(stored, store, block)
    blocks = store.blocks_of(folder)
    start = snapshots.Manifest(0, stored.schema.json(), block)
    store.commit(lambda manifest: (manifest or start).with_rows(folder, blocks))


def _write_folder(rows: DataFrame, store: snapshots.Store, block: int) -> str:
    """The rows in a new folder, which nobody reads yet."""
    folder = uuid.uuid4().hex
    (
        rows.withColumn("block", _block(F.col("id"), block))
        .repartitionByRange("block", "id")
        .sortWithinPartitions("block", "id")
        .write.partitionBy("block")
        .parquet(f"{store.root}/{snapshots.DATA}/{folder}")
    )
    return folder


def _stored(store: snapshots.Store, manifest: snapshots.Manifest, blocks: list[str], deltas: bool) -> DataFrame:
    """All rows of some blocks, versions included."""
    spark, kind = store.spark, manifest.row_type
    paths = manifest.paths(store.root, blocks, deltas)
    return spark.read.schema(kind).parquet(*paths) if paths else spark.createDataFrame([], kind)


def _reconciled(store: snapshots.Store, manifest: snapshots.Manifest, blocks: list[str]) -> DataFrame:
    """One row per id of blocks that have deltas, the one of the highest version.

    Only id, version and place of the rows are compared. Those of older versions are written as a table, so that
    its size is known, and taken out of the rows by an anti join, which sends them to the scan if they
    are few.
    """
    stored = _stored(store, manifest, blocks, deltas=True)
    file = stored.metadataColumn("_metadata")
    place = F.struct(file["file_path"].alias("file"), file["row_index"].alias("at"))
    keys = stored.select("id", F.struct(F.col(VERSION), place.alias("place")).alias("rank"))
    newest = keys.groupBy("id").agg(F.max("rank").alias("top")).withColumnRenamed("id", "of")
    older = keys.join(newest, F.col("id").eqNullSafe(F.col("of"))).filter(F.col("rank") < F.col("top"))
    gone = scratch_path(store.spark, "older-versions")
    older.select(F.col("rank.place").alias("place")).write.parquet(gone)
    gone = store.spark.read.parquet(gone)
    return stored.withColumn("_place", place).join(gone, F.col("_place") == gone["place"], "left_anti").drop("_place")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The latest version of every item of an archive; items without an id count as one.

    Blocks without deltas are read as they are, without a shuffle. Only blocks with deltas are reconciled, by
    id and version.
    """
    store, manifest = snapshots.open_store(spark, path)
    return _without_version(_items_of(store, manifest, [*manifest.base]))


def _items_of(store: snapshots.Store, manifest: snapshots.Manifest, blocks: list[str]) -> DataFrame:
    touched = [b for b in blocks if b in manifest.deltas]
    untouched = [b for b in blocks if b not in manifest.deltas]
    rows = _stored(store, manifest, untouched, deltas=False)
    return rows.unionByName(_reconciled(store, manifest, touched)) if touched else rows


def _without_version(rows: DataFrame) -> DataFrame:
    return rows.drop(VERSION)


def upsert_archive(updates: DataFrame, path: str, sequence: str, block: int = BLOCK) -> None:
    """Merge new versions into an archive. What is stored is not read: the updates are added, and the
    highest sequence wins when the archive is read. Running the same updates again changes nothing."""
    _, manifest = snapshots.open_store(updates.sparkSession, path)
    columns = [f.name for f in manifest.row_type if f.name != VERSION]
    if set(columns) != set(updates.columns):
        raise ValueError(f"the archive has the columns {columns}, the updates {updates.columns}")
    # Versions of equal sequence are settled by their content, in the stored order of columns.
    write_archive(updates.select(*columns), path, sequence, block)


def compact_blocks(spark: SparkSession, path: str, min_deltas: int = 1) -> list[str]:
    """Give the blocks that have so many deltas a new base, and return them. Other blocks are neither read
    nor written. Deltas that are added meanwhile stay deltas; if somebody else compacted one of the blocks
    meanwhile, nothing changes and Conflict is raised."""
    store, manifest = snapshots.open_store(spark, path)
    blocks = [b for b, own in manifest.deltas.items() if len(own) >= min_deltas]
    if blocks:
        folder = _write_folder(_reconciled(store, manifest, blocks), store, manifest.block)
        merged = {b: [manifest.base[b], *manifest.deltas[b]] for b in blocks}
        store.commit(lambda now: now.compacted(folder, merged))
    return blocks


def expire_archive(spark: SparkSession, path: str, keep: int = 2, older_than: float = 86_400.0) -> list[str]:
    """Delete manifests but the newest ones, and the folders that only they named."""
    return snapshots.Store(spark, path).expire(keep, older_than)


def compact_archive(
    spark: SparkSession, path: str, target: str, sequence: str, block: int = BLOCK
) -> None:
    """Write the latest versions alone to a new archive, which readers turn to when it is complete."""
    write_archive(read_archive(spark, path), target, sequence, block)


def archive_lookup(ids: DataFrame, path: str, pushed: int = PUSHED_IDS) -> DataFrame:
    """One row per distinct id with the archived item's columns; all NULL but the id where there is none.

    Only blocks that one of the ids is in are opened: the driver gets their numbers, never more than the archive
    has blocks. Up to ``pushed`` ids go into the scan as a filter, which the files' statistics turn into a
    few row groups and pages, since rows are sorted by id; for more ids, the lowest and the highest
    of them do. Blocks with deltas are reconciled by id and version, of these rows alone.
    """
    spark = ids.sparkSession
    store, manifest = snapshots.open_store(spark, path)
    wanted = ids.select("id").distinct()
    few = [r["id"] for r in wanted.filter("id IS NOT NULL").limit(pushed + 1).collect()]
    if len(few) <= pushed:
        asked = {_block_name(i, manifest.block) for i in few}
        condition = F.col("id").isin(few)
    else:
        numbers = wanted.select(_block(F.col("id"), manifest.block).alias("b")).distinct().filter("b IS NOT NULL")
        asked = {str(r["b"]) for r in numbers.collect()}
        low, high = wanted.agg(F.min("id"), F.max("id")).first()
        condition = F.col("id").between(low, high)
    blocks = [b for b in manifest.base if b in asked]
    found = _stored(store, manifest, blocks, deltas=True).filter(condition)
    if any(b in manifest.deltas for b in blocks):
        found = _newest(found, "id", F.col(VERSION), found.columns)
    return wanted.join(_without_version(found), "id", "left")


def _block_name(id_: int, block: int) -> str:
    return str(id_ // block)
