"""Near duplicates by SimHash fingerprints, found with BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.components import components
from quillstream.llm.shared import packed, pieces, settle, without
from quillstream.session import ship_package

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
BITS = 64
# Blocks of a fingerprint. Two that differ in at most RADIUS bits agree in all but RADIUS blocks.
BLOCKS = 4
TREE_NODES = 1024
# Blocks that the bits outside a large shard's are cut into again.
SUB_BLOCKS = 4
# Shingles whose bits are counted at a time.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text as an unsigned 64-bit number.

    Words are runs without ASCII white space, A-Z in lower case. A text of fewer words than a shingle
    has one shingle of them all; a text without words has fingerprint 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    spans = [words[i:] for i in range(min(shingle_words, len(words)))]
    total = len(spans[-1])
    ones = np.zeros(BITS, dtype=np.int64)
    shingles = zip(*spans, strict=False)
    digest, join = xxhash.xxh64_digest, b" ".join
    for start in range(0, total, CHUNK):
        size = min(CHUNK, total - start)
        hashes = b"".join([digest(join(next(shingles)), SEED) for _ in range(size)])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8)).reshape(size, BITS)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


class BKTree:
    """Distinct fingerprints; a child hangs on the edge of its Hamming distance to the parent."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while True:
            distance = (value ^ node[0]).bit_count()
            if distance == 0:
                return
            child = node[1].get(distance)
            if child is None:
                node[1][distance] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Stored values at most radius bits away, by following only edges that can lead to one."""
        waiting = [self.root] if self.root is not None else []
        while waiting:
            stored, children = waiting.pop()
            distance = (value ^ stored).bit_count()
            if distance <= radius:
                yield stored
            for edge in range(max(1, distance - radius), distance + radius + 1):
                child = children.get(edge)
                if child is not None:
                    waiting.append(child)


def linked(members: list[int], others: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Enough links to connect all that are within the radius: members with each other if there are
    no others, else others with members. One per value at most, to a value linked before."""
    tree, root = BKTree(), {v: v for v in members + others}

    def find(v: int) -> int:
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    if others:
        for value in members:
            tree.add(value)
    for value in others or members:
        for near in tree.within(value, radius):
            a, b = find(value), find(near)
            if a != b:
                root[max(a, b)] = min(a, b)
                yield value, near
        if not others:
            tree.add(value)


def _search(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, first and second block of it; a tree for each such combination."""
    key, i, members, others = None, 0, [], []

    def links() -> Iterator[tuple[int, int]]:
        mask = (1 << BITS) - 1
        for a, b in linked([v & mask for v in members], [v & mask for v in others], radius):
            yield _signed(a), _signed(b)

    for batch in batches:
        found: list[tuple[int, int]] = []
        columns = (batch.column(c).to_pylist() for c in ("mask", "bits", "i", "j", "own", "value"))
        for *place, own, value in zip(*columns, strict=True):
            if place != key:
                found += links()
                key, members, others = place, [], []
                i = place[2]
            (members if own == i else others).append(value)
        if found:
            yield _pairs(found)
    if found := list(links()):
        yield _pairs(found)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _cut(bits: list[int], blocks: int) -> list[list[int]]:
    """The bits in that many blocks, sizes as equal as can be."""
    return [bits[len(bits) * b // blocks : len(bits) * (b + 1) // blocks] for b in range(blocks)]


def _choices(bits: list[int], blocks: int, radius: int) -> list[int]:
    """Masks of all choices of blocks - radius blocks of the bits: two values that differ in at most radius of
    these bits agree in all bits of one of the masks at least."""
    return [sum(1 << b for block in chosen for b in block) for chosen in combinations(_cut(bits, blocks), blocks - radius)]


def _agreeing(masks: list[int]) -> Column:
    """mask and bits, the value's bits in it, for each of the masks."""
    return F.array(
        *[
            F.struct(F.lit(_signed(m)).alias("mask"), F.col("value").bitwiseAND(F.lit(_signed(m))).alias("bits"))
            for m in masks
        ]
    )


def _sizes(rows: DataFrame, name: str) -> DataFrame:
    """mask, bits and n, the number of values, of the shards of two values or more."""
    return settle(rows.groupBy("mask", "bits").agg(F.count("*").alias("n")).filter("n > 1"), name)


def _shards(fps: DataFrame, radius: int, tree_nodes: int) -> DataFrame:
    """mask, bits, value and n, the size of the shard. Every fingerprint stands once for each choice of BLOCKS - radius
    blocks, so that two within the radius share a shard at least.

    Shards of more than tree_nodes are cut again by their other bits, in the same way. Two in one of those agree in all
    but radius of BLOCKS blocks and all but radius of SUB_BLOCKS blocks of the rest.
    """
    key = ["mask", "bits"]
    everything = list(range(BITS))
    outer = _choices(everything, BLOCKS, radius)
    rows = fps.select(F.explode(_agreeing(outer)).alias("shard"), "value").select("shard.*", "value")
    sizes = _sizes(rows, "shards")
    sized = rows.join(sizes, key)
    if sizes.filter(F.col("n") > tree_nodes).isEmpty():
        return sized
    inner = F.lit(None)
    for mask in outer:
        rest = [b for b in everything if not mask >> b & 1]
        masks = [mask | more for more in _choices(rest, max(SUB_BLOCKS, radius + 1), radius)]
        inner = F.when(F.col("mask") == _signed(mask), _agreeing(masks)).otherwise(inner)
    large = sized.filter(F.col("n") > tree_nodes).select(F.explode(inner).alias("shard"), "value")
    # Shards cut in different ways may come to the same bits.
    again = settle(large.select("shard.*", "value").distinct(), "shards-cut")
    small = sized.filter(F.col("n") <= tree_nodes)
    return small.unionByName(again.join(_sizes(again, "shards-again"), key))


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Links a, b between distinct fingerprints (column value, signed), enough to connect all pairs
    that differ in at most radius bits.

    Fingerprints that agree in BLOCKS - radius of BLOCKS blocks make up a shard. A shard of more than
    tree_nodes fingerprints is cut again by the bits outside these blocks; at the registered radius of 2 those
    shards agree in 48 bits, so none can hold more than 2^16. What is still too large is cut into parts,
    each with a tree of its own that is sent to every other part of the shard, so no task holds more than two
    parts and no fingerprint has more than 64 copies in a shard. A tree goes only where its shard
    has queries: to send it everywhere would be a broadcast that grows with the corpus.
    """
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"radius must be from 0 to {BLOCKS - 1}")
    ship_package(fps.sparkSession)
    parts = F.ceil(F.col("n") / tree_nodes).cast("int")
    combined = (
        _shards(fps, radius, tree_nodes)
        .select("mask", "bits", "value", F.pmod(F.xxhash64("value"), parts).cast("int").alias("own"), parts.alias("parts"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("mask", "bits", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "value")
    )
    found = (
        combined.repartition("mask", "bits", "i", "j")
        .sortWithinPartitions("mask", "bits", "i", "j", "value")
        .mapInArrow(lambda batches: _search(batches, radius), "a long, b long")
    )
    return settle(found.distinct(), "fingerprint-links")


def fingerprints(texts: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """rid, id and text to rid, id and value, the fingerprint as signed number; settled."""
    ship_package(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            values = [_signed(fingerprint(t, shingle_words)) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("rid"), part.column("id"), pa.array(values, pa.int64())], ["rid", "id", "value"]
            )

    schema = texts.select("rid", "id", F.lit(0).cast("long").alias("value")).schema
    return settle(texts.mapInArrow(run, schema), "fingerprints")


def _groups(texts: DataFrame, shingle_words: int, radius: int, tree_nodes: int) -> DataFrame:
    rows = fingerprints(texts, shingle_words)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("first")
    fps = settle(rows.groupBy("value").agg(first), "fingerprint-groups")
    roots = components(fingerprint_links(fps.select("value"), radius, tree_nodes))
    firsts = settle(
        roots.join(fps, F.col("vertex") == F.col("value")).groupBy("root").agg(F.min("first").alias("least")),
        "component-firsts",
    )
    members = roots.join(firsts, "root").select(F.col("vertex").alias("value"), "least")
    table = settle(
        fps.join(members, "value", "left").select("value", F.coalesce("least", "first").alias("first")),
        "fingerprint-components",
    )
    return rows.join(table, "value").select(
        "rid",
        "id",
        F.lower(F.lpad(F.hex("value"), BITS // 4, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
        (F.col("rid") == F.col("first.rid")).alias("kept"),
    )


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    tree_nodes: int = TREE_NODES,
) -> DataFrame:
    """Documents linked, over any number of steps, by fingerprints at most radius bits apart.

    Returns one row per input row: rid, id, fingerprint (16 hex digits), component_id (the smallest
    id that can be reached) and kept (true for one row of each component, one with the smallest id).
    A text that is null, empty or blank has fingerprint zero, which links like any other. Null ids
    don't count for component_id, which is null where a component has no other; repeated rows are in
    one component and one of them stays. An empty table gives an empty result. Other columns are
    never looked at; texts of any length are read whole.

    Copies meet as one fingerprint, combined before the shuffle; only distinct fingerprints that share
    a shard with another reach a tree.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
    )
    return _groups(texts, shingle_words, radius, tree_nodes)


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    tree_nodes: int = TREE_NODES,
) -> DataFrame:
    """The input rows, columns as they were, one of each component."""
    rows = packed(docs)
    row = F.col("row")
    texts = rows.select(
        "rid", row.getField(id_col).alias("id"), row.getField(text_col).cast("string").alias("text")
    )
    return without(rows, _groups(texts, shingle_words, radius, tree_nodes).filter("NOT kept"))
