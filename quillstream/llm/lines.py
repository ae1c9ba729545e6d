"""Quality rules with the frequency of lines across the documents of a host."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.shared import packed, settle
from quillstream.llm.words import chunks, coded_words, row_sums
from quillstream.session import ship_package

WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A line is too frequent in more distinct documents of a host than this, however large the host, ...
MAX_DOCUMENTS = 100
# ... or in more than this share of them, ...
MAX_SHARE = 0.1
# ... if these are more than so many.
MIN_DOCUMENTS = 5
# A document is depleted if it keeps a smaller share of its words than this.
MIN_KEPT_SHARE = 0.5

# Bits of the map of frequent lines that tasks hold, a fixed 16 MB, and of one row of the bitmap functions.
MAP_MASK = (1 << 27) - 1
MAP_ROW = 1 << 15

SYMBOLS = r"[#*$%&|<>]"
FACTS = (
    "rid {rid}, id {id}, host {host}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, content long, lines array<struct<hash:long,words:long,times:long>>"
)


def normalised_line(line: bytes) -> bytes:
    """A-Z in lower case, words with one blank between."""
    return b" ".join(line.lower().split())


def _hash(data: bytes) -> int:
    return int.from_bytes(xxhash.xxh64_digest(data), "big", signed=True)


def repeated_words(codes: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """For each text, its words that lie in a window of width words found twice or more in it."""
    count = len(codes)
    covered = np.zeros(count + 1, dtype=np.int32)
    if count >= width:
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        inside = np.flatnonzero(row[: count - width + 1] == row[width - 1 :])
        keys = [codes[inside + k] for k in range(width)] + [row[inside]]
        order = np.lexsort(keys)
        same = np.ones(max(len(order) - 1, 0), dtype=bool)
        for key in keys:
            key = key[order]
            same &= key[1:] == key[:-1]
        twice = np.zeros(len(order), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        begins = inside[order[twice]]
        np.add.at(covered, begins, 1)
        np.add.at(covered, begins + width, -1)
    return row_sums((np.cumsum(covered[:-1]) > 0).astype(np.int64), offsets)


def _facts(batches: Iterator[pa.RecordBatch], window: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        texts = pc.fill_null(chunk.column("text"), "")
        words, codes, offsets = coded_words(texts)
        if "" in words:
            # White space at either end of a text makes an empty word.
            real = codes != words.index("")
            offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
            codes = codes[real]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = pc.count_substring_regex(texts, SYMBOLS).to_numpy().astype(np.int64)
        lines, repeats, content = [], [], []
        for text in texts.to_pylist():
            data = text.encode("utf-8", "surrogatepass")
            content.append(_hash(data))
            seen: dict[bytes, list[int]] = {}
            exact: set[bytes] = set()
            again = 0
            for line in data.split(b"\n"):
                line_words = line.lower().split()
                if not line_words:
                    continue
                again += line in exact
                exact.add(line)
                entry = seen.setdefault(b" ".join(line_words), [len(line_words), 0])
                entry[1] += 1
            repeats.append(again)
            lines.append([{"hash": _hash(k), "words": w, "times": n} for k, (w, n) in seen.items()])
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("rid"),
                chunk.column("id"),
                chunk.column("host"),
                pa.array(np.diff(offsets)),
                pa.array(row_sums(lengths[codes] if len(codes) else lengths[:0], offsets)),
                pa.array(symbols),
                pa.array(repeats, pa.int64()),
                pa.array(repeated_words(codes, offsets, window)),
                pa.array(content, pa.int64()),
                pa.array(lines, schema),
            ],
            ["rid", "id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content", "lines"],
        )


def _cleaned(batches: Iterator[pa.RecordBatch], known) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
    """Texts without the lines that are marked in the map, but for those whose hashes are spared, and the words
    that are left."""
    bits = known.value
    mask = 8 * len(bits) - 1
    for chunk in chunks(batches):
        texts, words = [], []
        columns = (chunk.column(c).to_pylist() for c in ("text", "mark", "spared"))
        for text, mark, spared in zip(*columns, strict=True):
            data = text.encode("utf-8", "surrogatepass")
            spared = set(spared or ())
            left, lines = [], data.split(b"\n")
            for line in lines:
                own = line.lower().split()
                if own:
                    found = _hash(b" ".join(own))
                    bit = (found ^ mark) & mask
                    if bits[bit >> 3] >> (bit & 7) & 1 and found not in spared:
                        continue
                left.append(line)
            if len(left) < len(lines):
                data = b"\n".join(left)
                text = data.decode("utf-8", "surrogatepass")
            texts.append(text)
            words.append(len(data.split()))
        yield pa.RecordBatch.from_arrays(
            [chunk.column("rid"), chunk.column("id"), pa.array(texts, pa.string()), pa.array(words, pa.int64())],
            ["rid", "id", "text", "kept_words"],
        )


def _bit(line: str, host: str) -> Column:
    return F.col(line).bitwiseXOR(F.xxhash64(host)).bitwiseAND(MAP_MASK)


def _map_of(marks: DataFrame):  # noqa: ANN202
    """A map of fixed size with these bits, sent to all tasks."""
    place = F.col("bit") + 1
    rows = (
        marks.groupBy(F.bitmap_bucket_number(place).alias("row"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    bits = bytearray((MAP_MASK + 1) // 8)
    for row in rows:
        begin = (row["row"] - 1) * MAP_ROW // 8
        bits[begin : begin + MAP_ROW // 8] = row["bits"]
    return marks.sparkSession.sparkContext.broadcast(bytes(bits))


def clean_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_share: float = MAX_SHARE,
    min_documents: int = MIN_DOCUMENTS,
    min_kept_share: float = MIN_KEPT_SHARE,
    max_documents: int = MAX_DOCUMENTS,
) -> tuple[DataFrame, DataFrame]:
    """The texts without the lines that too many documents of their host share, and the rules' verdicts.

    A line is normalised (A-Z in lower case, single blanks) and hashed; the distinct documents of its
    host that have it are counted, copies of a text as one. Lines in more than max_documents of them are
    removed, and those in more than max_share of the host's distinct documents, if these are more than
    min_documents; a document that keeps less than min_kept_share of its words is depleted. A null text has no
    lines, rows without a host are one host together, an empty table gives empty results.

    Returns two tables with one row per input row each. The first: rid, id, text without its frequent lines
    (all others as they were, blank ones too), kept_words. The second, as line_rules describes it, has the
    same rid and counts as removed what the first table's text lacks.

    Texts stay in the tasks that read them, and are read again to be cleaned. Which lines go is told by a map of
    fixed size, a bit for each frequent line and host; the few lines that share a bit with one and are not frequent
    themselves are found by a join on hashes, and go to the scan by row, sent to it if they are small. A document
    counts a line once, counts are combined before the shuffle, and no host is one task.
    """
    ship_package(docs.sparkSession)
    row = F.col("row")
    texts = packed(docs).select(
        "rid",
        row.getField(id_col).alias("id"),
        row.getField(host_col).alias("host"),
        F.coalesce(row.getField(text_col).cast("string"), F.lit("")).alias("text"),
    )
    kinds = dict(texts.dtypes)
    line = pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int64()), ("times", pa.int64())]))
    facts = settle(
        texts.mapInArrow(
            lambda batches: _facts(batches, WINDOW, line),
            FACTS.format(rid=kinds["rid"], id=kinds["id"], host=kinds["host"]),
        ),
        "line-facts",
    )
    each = facts.select("rid", "host", "content", F.explode("lines").alias("line")).select(
        "rid", "host", "content", "line.*"
    )
    hosts = facts.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("documents"))
    frequent = (
        each.select("host", "hash", "content")
        .distinct()
        .groupBy("host", "hash")
        .agg(F.count("*").alias("found"))
        .filter(F.col("found") > F.lit(min(min_documents, max_documents)))
    )
    in_many = F.col("found") > max_documents
    in_a_share = (F.col("found") > min_documents) & (F.col("found") > max_share * F.col("documents"))
    frequent = (
        frequent.join(hosts.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
        .filter(in_many | in_a_share)
        .select(F.col("host").alias("of"), F.col("hash").alias("which"))
    )
    frequent = settle(frequent, "frequent-lines")
    marks = frequent.select(_bit("which", "of").alias("bit")).distinct()
    known = _map_of(marks)
    spared = (
        each.withColumn("bit", _bit("hash", "host"))
        .join(marks, "bit", "left_semi")
        .join(frequent, F.col("host").eqNullSafe(F.col("of")) & (F.col("hash") == F.col("which")), "left_anti")
        .groupBy("rid")
        .agg(F.collect_list("hash").alias("spared"))
    )
    cleaned = (
        texts.withColumn("mark", F.xxhash64("host"))
        .join(settle(spared, "spared-lines"), "rid", "left")
        .select("rid", "id", "text", "mark", "spared")
        .mapInArrow(
            lambda batches: _cleaned(batches, known), f"rid {kinds['rid']}, id {kinds['id']}, text string, kept_words long"
        )
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    depleted = (F.col("n_words") - F.col("removed_words")) < min_kept_share * F.col("n_words")
    verdicts = (
        facts.drop("host", "content", "lines")
        .join(settle(cleaned.select("rid", "kept_words"), "kept-words"), "rid")
        .withColumn("removed_words", F.col("n_words") - F.col("kept_words"))
        .drop("kept_words")
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
    )
    return cleaned, verdicts


def line_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_share: float = MAX_SHARE,
    min_documents: int = MIN_DOCUMENTS,
    min_kept_share: float = MIN_KEPT_SHARE,
    max_documents: int = MAX_DOCUMENTS,
) -> DataFrame:
    """Rules within a document, and lines that too many documents of a host share.

    Returns one row per input row: rid, id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed (fewer than 50 words, or more than half of them in repeated windows of
    three), removed_words (those that clean_lines takes out of the text), kept (neither base_failed nor
    depleted). A null or empty text has no words and fails; rows without a host are one host together;
    repeated rows count as copies; an empty table gives an empty result. Other columns are never looked at.
    """
    return clean_lines(docs, id_col, text_col, host_col, max_share, min_documents, min_kept_share, max_documents)[1]
