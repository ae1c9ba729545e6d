"""Divergence of sources: term shares of a language's sources, compared over terms kept by iceberg prefix refinement."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.shared import settle
from quillstream.llm.spans import LOWER, byte_table, coded, mapped, rows_of, runs, text_bytes
from quillstream.llm.words import chunks
from quillstream.session import ship_package

MIN_DOCUMENTS = 3
TERMS_LISTED = 200
# Bytes of the first prefixes; each level doubles them.
FIRST_PREFIX = 4
SCALE = 1_000_000_000
FACTOR = 32_000
# Bits of the map of prefixes that go on, a fixed 2 MB.
MAP_BITS = 24
MAP_ROW = 1 << 15
# Bytes of text that one dictionary of terms is made of.
CHUNK_BYTES = 8 << 20
# Rows of terms that one task compares at a time, on average, and cells of its table of shares.
BLOCK_ROWS = 200_000
CELLS = 1 << 21

LETTER = byte_table((65, 90), (97, 122), (128, 255))
# A row without a source is that of a prefix.
FOUND = "lang string, source string, term binary, documents long, times long"


def _prints(prefixes: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(p) for p in prefixes], dtype=np.uint64)


def _bit(prefixes: np.ndarray, language: np.ndarray) -> np.ndarray:
    mixed = (prefixes + language) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _marked(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0


def _codes(values: list[str]) -> tuple[list[str], np.ndarray]:
    names = {v: k for k, v in enumerate(dict.fromkeys(values))}
    return [*names], np.array([names[v] for v in values], dtype=np.int64)


def _level(batches: Iterator, low: int, high: int, known) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
    """Whole terms of more than low and at most high bytes, by language and source, and the first high bytes
    of longer ones, by language; only of those whose first low bytes are marked in the map."""
    bits = known.value if known else None
    for chunk in chunks(batches, size=CHUNK_BYTES):
        data, offsets = text_bytes(chunk.column("text"))
        starts, ends = runs(mapped(data, LETTER), offsets)
        longer = ends - starts > low
        starts, ends = starts[longer], ends[longer]
        if not len(starts):
            continue
        terms, codes = coded(mapped(data, LOWER), starts, ends)
        languages, language = _codes(chunk.column("lang").to_pylist())
        sources, source = _codes(chunk.column("source").to_pylist())
        row = rows_of(starts, offsets)
        if bits is not None:
            prefixes = _prints(pc.binary_slice(terms, 0, low).to_pylist())
            own = _prints([x.encode("utf-8", "surrogatepass") for x in languages])
            goes_on = _marked(bits, _bit(prefixes[codes], own[language[row]]))
            row, codes = row[goes_on], codes[goes_on]
        width = len(terms)
        # A document and a term once each, with the times that it has it.
        pairs, times = np.unique(row * width + codes, return_counts=True)
        row, codes = pairs // width, pairs % width
        whole = pc.less_equal(pc.binary_length(terms), high).to_numpy(zero_copy_only=False)[codes]

        group = language[row] * len(sources) + source[row]
        keys = (group * width + codes)[whole]
        order = np.argsort(keys, kind="stable")
        keys, held = keys[order], times[whole][order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        if len(first):
            group, code = keys[first] // width, keys[first] % width
            yield _batch(
                pa.array(languages, pa.string()).take(pa.array(group // len(sources))),
                pa.array(sources, pa.string()).take(pa.array(group % len(sources))),
                terms.take(pa.array(code)),
                np.diff(np.r_[first, len(keys)]),
                np.add.reduceat(held, first),
            )
        if whole.all():
            continue
        cut = pc.binary_slice(terms, 0, high).dictionary_encode()
        names, of = cut.dictionary, cut.indices.to_numpy().astype(np.int64)
        once = np.unique(row[~whole] * len(names) + of[codes[~whole]])
        keys, documents = np.unique(language[once // len(names)] * len(names) + once % len(names), return_counts=True)
        yield _batch(
            pa.array(languages, pa.string()).take(pa.array(keys // len(names))),
            pa.nulls(len(keys), pa.string()),
            names.take(pa.array(keys % len(names))),
            documents,
            np.zeros(len(keys), np.int64),
        )


def _batch(lang: pa.Array, source: pa.Array, term: pa.Array, documents: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    columns = [lang, source, term, pa.array(documents.astype(np.int64)), pa.array(times.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "documents", "times"])


def _print_bits(batches: Iterator) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = _prints([x.encode("utf-8", "surrogatepass") for x in batch.column("lang").to_pylist()])
        places = _bit(_prints(batch.column("term").to_pylist()), own)
        yield pa.RecordBatch.from_arrays([pa.array(places + 1)], ["bit"])


def _map_of(prefixes: DataFrame):  # noqa: ANN202
    """A map of fixed size with a bit for each language and prefix, sent to all tasks."""
    rows = (
        prefixes.select("lang", "term")
        .mapInArrow(_print_bits, "bit long")
        .groupBy(F.bitmap_bucket_number("bit").alias("row"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()
    )
    bits = np.zeros(1 << MAP_BITS - 3, np.uint8)
    for row in rows:
        begin = (row["row"] - 1) * MAP_ROW // 8
        bits[begin : begin + MAP_ROW // 8] = np.frombuffer(row["bits"], np.uint8)
    return prefixes.sparkSession.sparkContext.broadcast(bits)


def kept_terms(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, first_prefix: int = FIRST_PREFIX) -> DataFrame:
    """lang, source, term, times, of_lang (times in the language), first (one row of each term is): the terms
    that a language has in min_documents of its documents or more. docs: lang, source, text, without nulls.

    Level by level: the first pass counts the documents that have each prefix of first_prefix bytes, and
    terms that are no longer than that. Prefixes in fewer than min_documents go, those left are marked in
    a map of fixed size, and the next pass looks at terms that begin with one of them, with prefixes of
    twice as many bytes, until no prefix is left. Passes grow with the logarithm of the longest kept
    prefix. What a term shares a bit with may let it in for nothing; the last count is of whole terms.
    """
    ship_package(docs.sparkSession)
    levels, known, low = [], None, 0
    for high in (first_prefix << k for k in itertools.count()):
        found = docs.select("lang", "source", "text").mapInArrow(lambda b, lo=low, hi=high, k=known: _level(b, lo, hi, k), FOUND)
        counted = settle(
            found.groupBy("lang", "source", "term").agg(F.sum("documents").alias("documents"), F.sum("times").alias("times")),
            f"terms-{high}",
        )
        levels.append(counted.filter("source IS NOT NULL"))
        prefixes = counted.filter("source IS NULL").filter(F.col("documents") >= min_documents)
        if prefixes.isEmpty():
            break
        known, low = _map_of(prefixes), high
    whole = levels[0]
    for more in levels[1:]:
        whole = whole.union(more)
    of_term = Window.partitionBy("lang", "term")
    return (
        whole.withColumn("in_lang", F.sum("documents").over(of_term))
        .withColumn("of_lang", F.sum("times").over(of_term))
        .withColumn("first", F.col("source") == F.min("source").over(of_term))
        .filter(F.col("in_lang") >= min_documents)
        .select("lang", "source", F.col("term").cast("string").alias("term"), "times", "of_lang", "first")
    )


def _share(times: str) -> Column:
    """1 + floor(10^9 * (times + 1) / (words + terms)); null where there are no terms.

    Exact in 64 bits up to 2 * 10^14 words, and an error beyond: the factor comes in two parts, with the rest of the
    first division carried on.
    """
    first = f"(({times} + 1) * {SCALE // FACTOR})"
    by = "(words + terms)"
    share = f"1 + {first} div {by} * {FACTOR} + {first} % {by} * {FACTOR} div {by}"
    return F.expr(f"CASE WHEN terms > 0 THEN {share} END")


def _values(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _compare(terms: pa.Table, groups: pa.Table) -> pa.Table:
    """For a block of a language's terms, the sum of f over them for each source and each other one.

    Only cells that one of the two sources has are looked at one by one: the rest of the terms give all the same f.
    """
    order = groups.column("source").to_pylist()
    place = {s: k for k, s in enumerate(order)}
    size = len(order)
    total = np.zeros((size, size), dtype=np.int64)
    rows = terms.num_rows
    if rows:
        none = groups.column("none").to_numpy()
        source = terms.column("source").combine_chunks().dictionary_encode()
        source = np.array([place[s] for s in source.dictionary.to_pylist()])[source.indices.to_numpy()]
        term = terms.column("term").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        share = terms.column("share").to_numpy()
        by_term = np.argsort(term, kind="stable")
        term, source, share = term[by_term], source[by_term], share[by_term]
        step = max(1, CELLS // size)
        for begin in range(0, int(term[-1]) + 1, step):
            a, b = np.searchsorted(term, [begin, begin + step])
            _add_block(total, term[a:b] - begin, source[a:b], share[a:b], none)
    left, right = (x.ravel() for x in np.meshgrid(np.arange(size), np.arange(size), indexing="ij"))
    other = left != right
    lang = groups.column("lang").combine_chunks()
    names = pa.array(order, pa.string())
    return pa.table(
        {
            "lang": lang.take(pa.array(left[other])),
            "source": names.take(pa.array(left[other])),
            "item": names.take(pa.array(right[other])),
            "value": pa.array(total.ravel()[other]),
        }
    )


def _add_block(total: np.ndarray, term: np.ndarray, source: np.ndarray, share: np.ndarray, none: np.ndarray) -> None:
    size, count = len(none), int(term[-1]) + 1 if len(term) else 0
    table = np.broadcast_to(none, (count, size)).copy()
    has = np.zeros((count, size), dtype=bool)
    table[term, source] = share
    has[term, source] = True
    held = has.sum(axis=0)
    by_source = np.argsort(source, kind="stable")
    term, source, share = term[by_source], source[by_source], share[by_source]
    bounds = np.searchsorted(source, np.arange(size + 1))
    for g in range(size):
        own = slice(bounds[g], bounds[g + 1])
        others, both = table[term[own]], has[term[own]]
        total[g] += _values(share[own][:, None], others).sum(axis=0)
        # Terms that g lacks: those that the other one has, and those that neither has.
        absent = np.zeros(size, dtype=np.int64)
        np.add.at(absent, source, _values(none[g], share))
        total[g] += absent - np.where(both, _values(none[g], others), 0).sum(axis=0)
        neither = count - held[g] - held + both.sum(axis=0)
        total[g] += neither * _values(none[g], none)


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    terms_listed: int = TERMS_LISTED,
    first_prefix: int = FIRST_PREFIX,
) -> DataFrame:
    """How far each source of a language departs from the others, and in which terms from the language.

    Terms are runs of letters (A-Z in lower case, and all beyond ASCII); each language keeps those in
    min_documents of its documents. A kept term has the share p = 1 + floor(10^9 * (count + 1) / (N + V)) in
    every group, with N the group's counts of all V kept terms. f = floor((p - q)^2 / q). Returns lang,
    source, part, item, value, rank: in part "pair" each other source of the language with the sum of
    f over all kept terms, in part "term" the terms_listed terms with the largest f of those that the
    source has more of than the language, q being the language's share.

    Null texts, languages and sources are empty ones; repeated rows are documents of their own. A source
    without kept terms is compared like any other; a language without kept terms gives pairs of
    value 0; an empty table gives no rows. All numbers are exact.

    How it moves data: documents are read once a level, in which whole terms are counted by source within a few
    megabytes of text before the shuffle. Terms are then compared in blocks of a language, about
    200,000 rows each, and blocks hand on a row for each pair of sources, as the result has.
    """
    texts = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    )
    kept = settle(kept_terms(texts, min_documents, first_prefix), "kept-terms")
    groups = texts.select("lang", "source").distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("times").alias("words"))
    languages = kept.groupBy("lang").agg(F.sum("times").alias("words"), F.count_if("first").alias("terms"))
    groups = (
        groups.join(sums, ["lang", "source"], "left")
        .join(languages.select("lang", "terms"), "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("words", "terms")])
    )
    groups = settle(groups.withColumn("none", _share("CAST(0 AS BIGINT)")), "term-groups")
    shares = kept.join(groups, ["lang", "source"])
    blocks = -(-kept.count() // BLOCK_ROWS) or 1
    left = shares.select("lang", "source", "term", _share("times").alias("share"), F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"))
    right = groups.select("lang", "source", "none", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    compared = (
        left.groupBy("lang", "block")
        .cogroup(right.groupBy("lang", "block"))
        .applyInArrow(_compare, "lang string, source string, item string, value long")
    )
    pairs = compared.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    whole = languages.select("lang", F.col("words").alias("lang_words"))
    more = (
        shares.withColumn("p", _share("times"))
        .join(whole, "lang")
        .withColumn("words", F.col("lang_words"))
        .withColumn("q", _share("of_lang"))
        .filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    listed = more.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= terms_listed)
    return pairs.withColumn("rank", F.row_number().over(order)).union(listed)
