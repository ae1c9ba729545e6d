"""A streaming source of the ids that appeared since the last poll.

The position is the highest id seen, kept as stream offset in the checkpoint of the query, so ids
that appear while the query is down are emitted when it starts again. The driver only cuts the gap
into at most `tasks` ranges, however wide it is; the ids are made in the tasks, as Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from quillstream.session import ship_package

# Ids that are not worth a task of their own.
CHUNK = 100_000
TASKS = 1000
BATCH = 1 << 16


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.removeprefix("file:") if "://" not in path else path)


def _numbers(filesystem, name: str) -> list[int]:
    with filesystem.open_input_stream(name) as stream:
        return [int(n) for n in stream.read().split()]


def read_newest_id(path: str) -> int:
    """The newest id: the number in a text file, or in the newest file of a folder to which every poll adds
    one (the highest number, if several are as new). Any file system that Arrow knows will do."""
    from pyarrow import fs

    filesystem, name = _opened(path)
    if filesystem.get_file_info(name).type != fs.FileType.Directory:
        return max(_numbers(filesystem, name))
    found = [f for f in filesystem.get_file_info(fs.FileSelector(name)) if f.is_file and f.base_name[0] not in "._"]
    # A writer may leave files without a number behind, so older ones are looked at until there is one.
    for newest in sorted({f.mtime_ns for f in found}, reverse=True):
        numbers = [n for f in found if f.mtime_ns == newest for n in _numbers(filesystem, f.path)]
        if numbers:
            return max(numbers)
    raise ValueError(f"no number in {path}")


def highest_mark(path: str) -> int:
    """The highest id that any poll has read at the path, this one included. It is kept beside it, so that a
    newest id that goes back, between two polls or two runs, is no news."""
    from pyarrow import fs

    filesystem, name = _opened(f"{path.rstrip('/')}.highest")
    newest = read_newest_id(path)
    if filesystem.get_file_info(name).type == fs.FileType.File:
        kept = _numbers(filesystem, name)
        if kept and kept[0] >= newest:
            return kept[0]
    with filesystem.open_output_stream(name) as stream:
        stream.write(f"{newest}\n".encode())
    return newest


def id_ranges(last: int, newest: int, chunk: int, tasks: int = TASKS) -> list[tuple[int, int]]:
    """(last, newest] as closed ranges of at least ``chunk`` ids but for the last one, and at most ``tasks``
    of them."""
    size = max(chunk, -(-(newest - last) // tasks))
    return [(first, min(first + size - 1, newest)) for first in range(last + 1, newest + 1, size)]


@dataclass
class IdRange(InputPartition):
    first: int
    last: int


class FrontierReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.chunk = int(options.get("chunk", CHUNK))
        self.tasks = int(options.get("tasks", TASKS))
        self.start = options.get("startid")

    def initialOffset(self) -> dict:
        # Without a start id the first poll only sets the mark.
        return {"id": int(self.start) if self.start else highest_mark(self.path)}

    def latestOffset(self) -> dict:
        newest = highest_mark(self.path)
        return {"id": max(newest, int(self.start)) if self.start else newest}

    def partitions(self, start: dict, end: dict) -> list[IdRange]:
        return [IdRange(*ends) for ends in id_ranges(start["id"], end["id"], self.chunk, self.tasks)]

    def read(self, partition: IdRange) -> Iterator[pa.RecordBatch]:
        for first in range(partition.first, partition.last + 1, BATCH):
            ids = pa.array(np.arange(first, min(first + BATCH, partition.last + 1), dtype=np.int64))
            yield pa.RecordBatch.from_arrays([ids], ["id"])


class FrontierSource(DataSource):
    """Options: path (where the newest id is), startId (optional mark), chunk (least ids of a task), tasks
    (at most, a batch)."""

    @classmethod
    def name(cls) -> str:
        return "id_frontier"

    def schema(self) -> str:
        return "id bigint"

    def streamReader(self, schema) -> FrontierReader:
        return FrontierReader({k.lower(): v for k, v in self.options.items()})


def frontier_stream(
    spark: SparkSession, path: str, start_id: int | None = None, chunk: int = CHUNK, tasks: int = TASKS
) -> DataFrame:
    """Stream of new ids. ``path`` must be an absolute path or URI that the driver can read; the highest id
    read there is kept beside it, in a file of that name and ``.highest``."""
    ship_package(spark)
    spark.dataSource.register(FrontierSource)
    reader = spark.readStream.format("id_frontier").option("path", path)
    reader = reader.option("chunk", str(chunk)).option("tasks", str(tasks))
    if start_id is not None:
        reader = reader.option("startId", str(start_id))
    return reader.load()
