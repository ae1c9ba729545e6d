"""Models that grow with a stream: sums that add up over micro-batches, each counted once.

What the models are fitted on are sums over items: in how many each term is, how often words are near each
other, the moments of each class. A batch adds its own sums as a folder, and a manifest that names the
folder under the batch's number makes them count. A batch that runs again finds its number and changes
nothing. Folding replaces the folders by one of their sums, and remembers up to which batch it goes. While a
stream grows, batches are folded into parts, and a part into a later one that is as large, so a row is written
again only as often as the number of batches doubles.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from quillstream.operators import classify, embed, terms
from quillstream.sources.snapshots import DATA, Store


@dataclass(frozen=True)
class Sums:
    """base: folder of all that was folded as a whole; parts: folders of what was folded since, the oldest and
    largest first, with the number of batches in each; totals: numbers of the whole; through: for each source the
    last batch that was folded; batches: for each source and number of a later batch, its folder."""

    version: int = 0
    base: str | None = None
    parts: list[list] = field(default_factory=list)
    totals: dict[str, int] = field(default_factory=dict)
    through: dict[str, int] = field(default_factory=dict)
    batches: dict[str, dict[str, str]] = field(default_factory=dict)

    def has(self, source: str, number: int) -> bool:
        return number <= self.through.get(source, -1) or str(number) in self.batches.get(source, {})

    def folders(self) -> set[str]:
        """All that hold rows; ``expire`` asks for it too."""
        folded = {f for f, _ in self.parts} | ({self.base} if self.base else set())
        return folded | {f for own in self.batches.values() for f in own.values()}


class SumState:
    """A table of sums by key at a path, to which batches add theirs."""

    def __init__(self, spark: SparkSession, path: str, keys: str, sums: str) -> None:
        """keys and sums: columns with their types, as DDL."""
        self.store = Store(spark, path, Sums)
        self.schema = spark.createDataFrame([], f"{keys}, {sums}").schema
        self.sums = [c.split()[0] for c in sums.split(",")]
        self.keys = [c for c in self.schema.names if c not in self.sums]

    def _path(self, folder: str) -> str:
        return f"{self.store.root}/{DATA}/{folder}"

    def now(self) -> Sums:
        return self.store.current() or Sums()

    def add(self, number: int, rows: DataFrame, source: str = "stream", **totals: int) -> bool:
        """Add the sums of a batch, unless a batch of this number of the source was added before. Two drivers that
        add the same batch at the same time add it once."""
        if self.now().has(source, number):
            return False
        folder = uuid.uuid4().hex
        rows.select(*self.schema.names).write.parquet(self._path(folder))
        added = []

        def change(now: Sums | None) -> Sums:
            now = now or Sums()
            added[:] = [not now.has(source, number)]
            if not added[0]:
                return now
            own = {**now.batches.get(source, {}), str(number): folder}
            sums = {k: now.totals.get(k, 0) + totals.get(k, 0) for k in {*now.totals, *totals}}
            return replace(now, batches={**now.batches, source: own}, totals=sums)

        self.store.commit(change)
        return added[0]

    def _summed(self, folders: set[str], folded: str | None = None) -> DataFrame:
        if not folders:
            return self.store.spark.createDataFrame([], self.schema)
        rows = self.store.spark.read.schema(self.schema).parquet(*map(self._path, sorted(folders)))
        if folders == {folded}:
            return rows
        return rows.groupBy(*self.keys).agg(*[F.sum(c).cast(self.schema[c].dataType).alias(c) for c in self.sums])

    def table(self) -> DataFrame:
        """The sums of all batches. Just folded, they are read without a shuffle."""
        now = self.now()
        return self._summed(now.folders(), now.base)

    def totals(self) -> dict[str, int]:
        return self.now().totals

    def fold(self, whole: bool = True) -> None:
        """Put the sums of all batches so far into one folder, or, unless ``whole``, those of the batches that are
        not folded yet and of the parts that have no more batches. Batches that are added meanwhile stay apart."""
        seen = self.now()
        if not seen.batches and not (whole and seen.parts):
            return
        left_parts = [] if whole else list(seen.parts)
        gone = {f for own in seen.batches.values() for f in own.values()}
        n = len(gone)
        while left_parts and left_parts[-1][1] <= n:
            part, own = left_parts.pop()
            gone, n = gone | {part}, n + own
        folder = uuid.uuid4().hex
        self._summed(seen.folders() if whole else gone).write.parquet(self._path(folder))

        def change(now: Sums) -> Sums:
            if (now.base, now.parts) != (seen.base, seen.parts):
                return now  # somebody else folded
            left = {s: {n: f for n, f in own.items() if n not in seen.batches.get(s, {})} for s, own in now.batches.items()}
            through = dict(now.through)
            for source, own in seen.batches.items():
                through[source] = max([through.get(source, -1), *map(int, own)])
            folded = {"base": folder, "parts": []} if whole else {"parts": [*left_parts, [folder, n]]}
            return replace(now, **folded, through=through, batches={s: own for s, own in left.items() if own})

        self.store.commit(change)

    def expire(self, keep: int = 2, older_than: float = 86_400.0) -> list[str]:
        return self.store.expire(keep, older_than)


class GrowingIdf:
    """Document frequencies of whitespace tokens; batches hold a tokens column."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.state = SumState(spark, path, "term string", "df bigint")

    def add(self, items: DataFrame, number: int, source: str = "stream") -> bool:
        if self.state.now().has(source, number):
            return False
        return self.state.add(number, terms.document_frequency(items), source, n_docs=items.count())

    def save(self, path: str, min_doc_freq: int = 0) -> terms.IdfTable:
        """The IDF table of all batches so far, at a new path."""
        return terms.idf_table(self.state.table(), self.state.totals().get("n_docs", 0), path, min_doc_freq)


class GrowingVectors:
    """Neighbour counts of the words of a text column."""

    def __init__(self, spark: SparkSession, path: str, size: int = 128, window: int = 2) -> None:
        self.size, self.window = size, window
        self.state = SumState(spark, path, "cell bigint", "n bigint, own bigint")

    def add(self, items: DataFrame, number: int, source: str = "stream") -> bool:
        return self.state.add(number, embed.neighbour_counts(items, self.size, self.window), source)

    def save(self, path: str) -> str:
        """The word vectors of all batches so far, at a new path. Counts that cancel out are zeros of a vector."""
        return embed.vectors_of(self.state.table(), path, self.size)


class GrowingClassifier:
    """Moments of both classes; the vectors of all batches come from one and the same encoder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.state = SumState(spark, path, "position int, label int", "n double, s double, ss double")

    def add(self, vectors: DataFrame, labels: DataFrame, number: int, source: str = "stream") -> bool:
        return self.state.add(number, classify.class_sums(vectors, labels), source)

    def save(self, path: str) -> str:
        return classify.discriminant_of(self.state.table(), path)


def grow(items: DataFrame, model: GrowingIdf | GrowingVectors, checkpoint: str, fold_every: int = 64) -> DataStreamWriter:
    """Add every batch of a stream of items to a model, once, whatever fails; fold every so many batches into a
    part, so the rewriting does not grow with the square of the stream."""

    def add(batch: DataFrame, number: int) -> None:
        model.add(batch, number)
        if number % fold_every == fold_every - 1:
            model.state.fold(whole=False)

    return items.writeStream.outputMode("append").foreachBatch(add).option("checkpointLocation", checkpoint)
