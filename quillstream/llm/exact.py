"""Exact duplicates by deterministic block naming."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.shared import packed, settle, whole_text, without

BLOCK_CHARS = 4096


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Column | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Groups of equal texts; one row stays of each.

    Texts are cut into blocks of block_chars characters. Every distinct block gets an integer name,
    its place in a sorted partition. Then adjacent names of a document are paired and every distinct
    pair gets a name, until one name is left: its level and name stand for the whole text, and two
    texts share them only if they are equal, character by character.

    normalise: what is compared instead of the text.

    Returns one row per input row: rid, id, keep_id, group_size, kept, text_sha256. Of
    equal texts the row with the largest id stays, of equal ids an arbitrary single one. A null text
    counts as empty; a null id is less than any other; an empty table gives an empty result. Texts
    of any length are compared whole; other columns are never looked at.

    How it moves data: texts stay where they are read. Blocks travel as their length and 128 bits, which is
    exact because no two distinct blocks share both: bits that more than one block has are
    checked, by shuffling the blocks of the texts that have such bits, copies combined before that, and other bits
    are taken if two distinct blocks ever share theirs. Joins at names of many copies are split by adaptive
    execution.
    """
    text = whole_text(text_col) if normalise is None else F.coalesce(normalise, F.lit(""))
    rows = packed(docs.select(F.col(id_col).alias("id"), text.alias("value")))
    return _groups(rows.select("rid", "row.id", "row.value"), block_chars)


def _groups(texts: DataFrame, block_chars: int) -> DataFrame:
    """From rid, id and value, the text without nulls."""
    rows = _unmistakable(texts, block_chars)
    names = _block_names(rows)

    named = rows.select(
        F.col("no").alias("rid"), "id", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "bits")
    )
    named = settle(
        named.join(names, F.col("bits") == names["block_bits"]).select(
            "rid", "id", "n", F.col("pos").cast("long").alias("pos"), "name"
        ),
        "exact-0",
    )
    longest = named.agg(F.max("n")).first()[0] or 1
    done = [named.filter("n = 1").select("rid", "id", F.lit(0).alias("level"), "name")]
    for level in itertools.count(1):
        if 2 ** (level - 1) >= longest:
            break
        named = _pair_up(named, level)
        done.append(named.filter("n = 1").select("rid", "id", F.lit(level).alias("level"), "name"))
    identity = done[0]
    for more in done[1:]:
        identity = identity.union(more)

    groups = settle(
        identity.groupBy("level", "name").agg(
            F.count("*").alias("group_size"), F.max(F.struct("id", "rid")).alias("last")
        ),
        "exact-groups",
    )
    verdicts = identity.join(groups, ["level", "name"]).select(
        F.col("rid").alias("no"),
        F.col("last.id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("last.rid")).alias("kept"),
    )
    return rows.join(verdicts, "no").select(
        "rid", "id", "keep_id", "group_size", "kept", "text_sha256"
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows without all but one of equal texts, columns as they were."""
    rows = packed(docs)
    row = F.col("row")
    value = F.coalesce(row.getField(text_col).cast("string"), F.lit(""))
    texts = rows.select("rid", row.getField(id_col).alias("id"), value.alias("value"))
    return without(rows, _groups(texts, BLOCK_CHARS).filter("NOT kept"))


def _cut(column: str, block_chars: int) -> Column:
    """Blocks of block_chars characters, the last one shorter; an empty text is one empty block."""
    blocks = F.regexp_extract_all(F.col(column), F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    return F.when(F.col(column) == "", F.array(F.lit(""))).otherwise(blocks)


def _bits(block: Column, seed: int) -> Column:
    return F.struct(
        F.length(block).alias("length"),
        F.xxhash64(F.lit(2 * seed), block).alias("hi"),
        F.xxhash64(F.lit(2 * seed + 1), block).alias("lo"),
    )


def _unmistakable(texts: DataFrame, block_chars: int) -> DataFrame:
    """rid, no (a number for rid), id, text_sha256 and blocks, the length and bits of each block, which no
    other block shares."""
    for seed in itertools.count():
        rows = settle(
            texts.select(
                "rid",
                F.monotonically_increasing_id().alias("no"),
                "id",
                F.sha2("value", 256).alias("text_sha256"),
                F.transform(_cut("value", block_chars), lambda b, s=seed: _bits(b, s)).alias("blocks"),
            ),
            "exact-rows",
        )
        each = rows.select("rid", F.explode("blocks").alias("bits"))
        shared = settle(each.groupBy("bits").count().filter("count > 1").select("bits"), "exact-shared")
        holders = settle(each.join(shared, "bits").select("rid").distinct(), "exact-holders")
        blocks = texts.join(holders, "rid", "left_semi").select(F.explode(_cut("value", block_chars)).alias("block"))
        distinct = blocks.select(_bits(F.col("block"), seed).alias("bits"), "block").distinct()
        if distinct.groupBy("bits").count().filter("count > 1").isEmpty():
            return rows
    raise AssertionError


def _block_names(rows: DataFrame) -> DataFrame:
    """The name of every distinct block: its place among the sorted ones."""
    distinct = rows.select(F.explode("blocks").alias("block_bits")).distinct()
    return settle(
        distinct.sortWithinPartitions("block_bits").select(
            "block_bits", F.monotonically_increasing_id().alias("name")
        ),
        "exact-names",
    )


def _pair_up(named: DataFrame, level: int) -> DataFrame:
    """One level up: half as many names for every document that has more than one."""
    odd = F.col("pos") % 2 == 1
    pairs = settle(
        named.filter("n > 1")
        .groupBy("rid", "id", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.shiftright("pos", 1).alias("pos"))
        .agg(
            F.max(F.when(~odd, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("right"),
        ),
        f"exact-pairs-{level}",
    )
    names = (
        pairs.select("left", "right")
        .distinct()
        .sortWithinPartitions("left", "right")
        .select("left", "right", F.monotonically_increasing_id().alias("name"))
    )
    return settle(
        pairs.join(names, ["left", "right"]).select("rid", "id", "n", "pos", "name"),
        f"exact-{level}",
    )
