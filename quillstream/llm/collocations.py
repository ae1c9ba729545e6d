"""Phrase collocations: n-grams counted by Rabin-Karp fingerprints, read back from the texts where frequent."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.shared import packed, settle
from quillstream.llm.spans import LOWER, byte_table, mapped, rows_of, runs, text_bytes
from quillstream.llm.words import chunks
from quillstream.session import ship_package

LONGEST = 3
MIN_FOUND = 10
TOP = 2000
# A phrase goes if a longer candidate around it is found in at least this share of its places.
WITHIN_PERCENT = 50
NO_LANGUAGE = "und"

BLANK = byte_table((9, 9), (32, 32))
SPLIT = byte_table((10, 13))
SPLIT[list(b".,;:!?")] = True
WORD = ~(BLANK | SPLIT)

# Bytes that get a prefix polynomial at a time, more where a piece is longer.
SEGMENT = 1 << 20
# n-grams gathered in a task before they are counted and handed on.
HELD = 1 << 20
# Bits of the map of frequent fingerprints that tasks hold, a fixed 16 MB.
MAP_BITS = 27
# Rows of the bitmap functions cover this many bits each.
MAP_ROW = 1 << 15
CHECK_BITS = 16
# First cut of the best phrases, in so many parts a language.
PARTS = 64

GRAMS = "fp long, found long, checks long, low long, high long"


class Polynomial:
    """Hashes of byte ranges from one prefix polynomial, modulo 2^64.

    A range from s to e hashes to the sum of symbol[byte j] * base^(s - j), so ranges are subtracted and
    shifted, and two words make the hash of both with a blank between.
    """

    def __init__(self, seed: int) -> None:
        self.symbol = np.array([xxhash.xxh64_intdigest(bytes([b]), seed) for b in range(256)], np.uint64)
        self.base = xxhash.xxh64_intdigest(b"base", seed) & ~7 | 5
        self.back = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    @staticmethod
    def _powers(base: int, count: int) -> np.ndarray:
        out = np.full(count, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out, out=out)

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            count = max(len(data), SEGMENT) + 1
            self.up, self.down = self._powers(self.base, count), self._powers(self.back, count)
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.symbol[data] * self.down[: len(data)], out=prefix[1:])
        return (prefix[ends] - prefix[starts]) * self.up[starts]

    def joined(self, left: np.ndarray, lengths: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left + self.down[lengths] * (self.symbol[32] + np.uint64(self.back) * right)


def _mixed(values: np.ndarray) -> np.ndarray:
    """The same values spread over all bits, none lost."""
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


class Grams:
    """n-grams of texts, as fingerprints that hold the language too.

    A fingerprint has fp_bits bits. The check is that of another polynomial.
    """

    def __init__(self, fp_bits: int) -> None:
        self.main, self.other = Polynomial(1), Polynomial(2)
        self.mask = np.uint64((1 << fp_bits) - 1)

    def _final(self, raw: np.ndarray, language: np.ndarray) -> np.ndarray:
        return _mixed(raw + language) & self.mask

    @staticmethod
    def _languages(languages: list[str], seed: int) -> np.ndarray:
        known = {x: xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), seed) for x in set(languages)}
        return np.array([known[x] for x in languages], dtype=np.uint64)

    def segments(self, texts: pa.Array, languages: list[str]) -> Iterator[Segment]:
        """Parts of the texts that end between pieces."""
        data, offsets = text_bytes(texts)
        data = mapped(data, LOWER)
        own = self._languages(languages, 3), self._languages(languages, 4)
        if not len(data):
            return
        split = mapped(data, SPLIT)
        marks = np.flatnonzero(split) + 1
        begin = 0
        while begin < len(data):
            # The last mark or text's end within the segment, else the first one after it.
            ends = [(x, int(np.searchsorted(x, begin + SEGMENT, side="right"))) for x in (marks, offsets)]
            end = max([int(x[at - 1]) for x, at in ends if at], default=begin)
            if end <= begin:
                end = min(int(x[at]) for x, at in ends if at < len(x))
            yield Segment(self, data[begin:end], split[begin:end], np.clip(offsets, begin, end) - begin, own)
            begin = end


class Segment:
    def __init__(self, grams: Grams, data: np.ndarray, split: np.ndarray, offsets: np.ndarray, own: tuple) -> None:
        self.grams, self.data, self.own = grams, data, own
        self.starts, self.ends = runs(mapped(data, WORD), offsets)
        self.rows = rows_of(self.starts, offsets)
        # Grows at every cut and at every text.
        self.piece = np.cumsum(split)[self.starts] + self.rows if len(self.starts) else self.rows
        self.raw = [[np.zeros(len(self.starts), np.uint64)] * 2]

    @cached_property
    def words(self) -> list[np.ndarray]:
        return [p.ranges(self.data, self.starts, self.ends) for p in (self.grams.main, self.grams.other)]

    def at(self, size: int) -> np.ndarray:
        """The words with which n-grams of that size begin."""
        count = len(self.starts)
        if size < 2:
            return np.arange(count)
        return np.flatnonzero(self.piece[: max(count - size + 1, 0)] == self.piece[size - 1 :])

    def _raw(self, size: int) -> list[np.ndarray]:
        """Hashes of the n-grams from every word on that has enough words after it, cut or not."""
        while len(self.raw) <= size:
            step = len(self.raw)
            if step == 1:
                self.raw.append(self.words)
                continue
            count = max(len(self.starts) - step + 1, 0)
            # The texts' own blanks don't count: one stands between two words.
            lengths = np.zeros(count, np.int64)
            for k in range(step - 1):
                lengths += (self.ends - self.starts)[k : k + count] + (k > 0)
            self.raw.append(
                [
                    p.joined(left[:count], lengths, word[step - 1 :][:count])
                    for p, left, word in zip((self.grams.main, self.grams.other), self.raw[step - 1], self.words, strict=True)
                ]
            )
        return self.raw[size]

    def prints(self, size: int, at: np.ndarray) -> np.ndarray:
        return self.grams._final(self._raw(size)[0][at], self.own[0][self.rows[at]])

    def checks(self, size: int, at: np.ndarray) -> np.ndarray:
        raw = self._raw(size)[1][at] + self.own[1][self.rows[at]]
        return (_mixed(raw) >> np.uint64(64 - CHECK_BITS)).astype(np.int64)

    def phrase(self, size: int, at: int) -> str:
        words = [self.data[self.starts[k] : self.ends[k]].tobytes() for k in range(at, at + size)]
        return b" ".join(words).decode("utf-8", "surrogatepass")


def _inside(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    place = prints & np.uint64((1 << MAP_BITS) - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _frequent_parts(segment: Segment, size: int, bits: np.ndarray | None) -> np.ndarray:
    """Where n-grams begin of which both parts, one word shorter, are marked in the map."""
    at = segment.at(size)
    if bits is None or not len(at):
        return at
    shorter = np.zeros(len(segment.starts), dtype=bool)
    wanted = segment.at(size - 1)
    shorter[wanted] = _inside(bits, segment.prints(size - 1, wanted))
    return at[shorter[at] & shorter[at + 1]]


def _summed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    prints, checks, places = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(prints)
    prints, checks, places = prints[order], checks[order], places[order]
    first = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(prints[first].view(np.int64)),
            pa.array(np.diff(np.r_[first, len(prints)])),
            pa.array(np.add.reduceat(checks, first)),
            pa.array(np.minimum.reduceat(places, first)),
            pa.array(np.maximum.reduceat(places, first)),
        ],
        ["fp", "found", "checks", "low", "high"],
    )


def _counted(batches: Iterator, sizes: tuple, fp_bits: int, known) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
    grams, bits = Grams(fp_bits), known.value if known else None
    held, count = [], 0
    for chunk in chunks(batches):
        places = chunk.column("place").to_numpy()
        for segment in grams.segments(chunk.column("text"), chunk.column("lang").to_pylist()):
            for size in sizes:
                at = _frequent_parts(segment, size, bits)
                held.append((segment.prints(size, at), segment.checks(size, at), places[segment.rows[at]]))
                count += len(at)
            if count >= HELD:
                yield _summed(held)
                held, count = [], 0
        pa.default_memory_pool().release_unused()
    if count:
        yield _summed(held)


def _named(batches: Iterator, longest: int, fp_bits: int) -> Iterator[pa.RecordBatch]:
    """The phrase of each wanted fingerprint that is in the text."""
    grams = Grams(fp_bits)
    for chunk in chunks(batches):
        languages = chunk.column("lang").to_pylist()
        lists = chunk.column("wanted")
        asked, place = np.unique(lists.flatten().to_numpy().view(np.uint64), return_inverse=True)
        if not len(asked):
            continue
        # Pairs of a row and a fingerprint that it is asked for.
        pairs = np.sort(np.repeat(np.arange(chunk.num_rows), lists.value_lengths().to_numpy()) * len(asked) + place)
        found: dict[tuple, tuple] = {}
        for segment in grams.segments(chunk.column("text"), languages):
            for size in range(longest + 1):
                at = segment.at(size)
                prints = segment.prints(size, at)
                place = np.searchsorted(asked[:-1], prints)
                keys = segment.rows[at] * len(asked) + place
                hit = np.flatnonzero((asked[place] == prints) & (pairs[np.searchsorted(pairs[:-1], keys)] == keys))
                checks = segment.checks(size, at[hit])
                _, one = np.unique(keys[hit] << CHECK_BITS | checks, return_index=True)
                for k in one.tolist():
                    row, fp = int(segment.rows[at[hit[k]]]), int(prints[hit[k] : hit[k] + 1].view(np.int64)[0])
                    phrase = segment.phrase(size, int(at[hit[k]]))
                    found[row, fp, phrase, size] = (fp, int(checks[k]), languages[row], size, phrase)
        yield _as_batch(
            [*found.values()],
            [("fp", pa.int64()), ("check", pa.int64()), ("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string())],
        )


def _as_batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)], schema=pa.schema(fields)
    )


def _recounted(batches: Iterator, longest: int, fp_bits: int, known) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
    """Phrases themselves, counted, of the fingerprints that are marked in the map."""
    grams, bits = Grams(fp_bits), known.value
    fields = [("fp", pa.int64()), ("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("found", pa.int64())]
    for chunk in chunks(batches):
        languages = chunk.column("lang").to_pylist()
        counts: dict[tuple, int] = {}
        for segment in grams.segments(chunk.column("text"), languages):
            for size in range(longest + 1):
                at = segment.at(size)
                prints = segment.prints(size, at)
                for k in np.flatnonzero(_inside(bits, prints)):
                    key = (int(prints[k : k + 1].view(np.int64)[0]), languages[segment.rows[at[k]]], size, segment.phrase(size, int(at[k])))
                    counts[key] = counts.get(key, 0) + 1
        yield _as_batch([(*k, n) for k, n in counts.items()], fields)


def _map_of(prints: DataFrame):  # noqa: ANN202
    """A map of fixed size with a bit for each fingerprint, sent to all tasks; others may share the bit."""
    bit = F.col("fp").bitwiseAND((1 << MAP_BITS) - 1) + 1
    rows = (
        prints.select(F.bitmap_bucket_number(bit).alias("row"), F.bitmap_bit_position(bit).alias("bit"))
        .groupBy("row")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    bits = np.zeros(1 << MAP_BITS - 3, np.uint8)
    for row in rows:
        begin = (row["row"] - 1) * MAP_ROW // 8
        bits[begin : begin + MAP_ROW // 8] = np.frombuffer(row["bits"], np.uint8)
    return prints.sparkSession.sparkContext.broadcast(bits)


def frequent_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    min_found: int = MIN_FOUND,
    fp_bits: int = 64,
) -> DataFrame:
    """lang, size, phrase, found: every phrase of up to longest words that a language has min_found times
    or more, and for each language a phrase of size 0 that is found as often as it has words.

    Words are what is between blanks and tabs, A-Z in lower case, phrases lie within pieces between
    sentence marks and line ends. Rows without a language are one language, "und"; a null text is empty;
    repeated rows count each.

    How it moves data: n-grams are hashed in the scan from prefix polynomials and counted by the
    million; the shuffle carries fingerprint, count, checksum and two of the rows that have it. Sizes come one
    after another. Of n words only those go on whose parts of n - 1 are marked in a map of frequent ones, a bit
    string of a fixed 16 MB: other n-grams that share a bit are shuffled for nothing, none is lost. Phrases are
    then read from two rows each. Where these differ, or the checksum is not that of the phrase for all
    its places, the fingerprint stands for more than one phrase, and these are counted as text.
    """
    spark = docs.sparkSession
    ship_package(spark)
    row = F.col("row")
    file = F.shiftleft(F.xxhash64("rid.file"), 32)
    texts = packed(docs).select(
        file.bitwiseOR(F.col("rid.at").bitwiseAND(0xFFFFFFFF)).alias("place"),
        F.coalesce(row.getField(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(row.getField(text_col).cast("string"), F.lit("")).alias("text"),
    )
    levels, known = [], None
    for sizes in [(0, 1), *((n,) for n in range(2, longest + 1))]:
        grams = texts.mapInArrow(lambda b, s=sizes, k=known: _counted(b, s, fp_bits, k), GRAMS)
        counted = (
            grams.groupBy("fp")
            .agg(*[f(c).alias(c) for f, c in ((F.sum, "found"), (F.sum, "checks"), (F.min, "low"), (F.max, "high"))])
            .filter(F.col("found") >= min_found)
        )
        levels.append(settle(counted, f"grams-{sizes[-1]}"))
        known = _map_of(levels[-1])
    counted = levels[0]
    for more in levels[1:]:
        counted = counted.union(more)
    wanted = (
        counted.select("fp", F.explode(F.array_distinct(F.array("low", "high"))).alias("place"))
        .groupBy("place")
        .agg(F.collect_set("fp").alias("wanted"))
    )
    named = texts.join(settle(wanted, "wanted-grams"), "place").mapInArrow(
        lambda b: _named(b, longest, fp_bits), "fp long, check long, lang string, size int, phrase string"
    )
    told = named.groupBy("fp").agg(
        F.min(F.struct("lang", "size", "phrase")).alias("one"),
        F.max(F.struct("lang", "size", "phrase")).alias("last"),
        F.min("check").alias("check"),
    )
    told = settle(counted.join(told, "fp", "left"), "told-grams")
    sure = (F.col("one") == F.col("last")) & (F.col("found") * F.col("check") == F.col("checks"))
    sure = F.coalesce(sure, F.lit(False))
    phrases = told.filter(sure).select("one.lang", "one.size", "one.phrase", "found")
    doubtful = told.filter(~sure).select("fp").distinct()
    if not doubtful.isEmpty():
        again = texts.mapInArrow(
            lambda b, k=_map_of(doubtful): _recounted(b, longest, fp_bits, k),
            "fp long, lang string, size int, phrase string, found long",
        )
        again = again.join(doubtful, "fp", "left_semi").groupBy("lang", "size", "phrase").agg(F.sum("found").alias("found"))
        phrases = phrases.union(settle(again.filter(F.col("found") >= min_found), "recounted-grams"))
    return phrases


def _exact(value: Column) -> Column:
    return value.cast("decimal(18,0)")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    min_found: int = MIN_FOUND,
    top: int = TOP,
    within_percent: int = WITHIN_PERCENT,
    fp_bits: int = 64,
) -> DataFrame:
    """The phrases of 2 to longest words whose words go together most, for each language.

    A phrase found a times, cut into parts that are found l and r times, scores floor(10^6 * a * a / (l * r)); of
    all cuts the lowest score counts, and the first of equal ones. A candidate inside a longer one that is found in
    within_percent of its places is left out. Returns lang, rank, phrase, a, l, r, n (words of the
    language), score: the best top of each language by score, a, then phrase. Texts without words, an empty
    table and languages without a phrase found min_found times give no rows; nulls are as in
    frequent_phrases. All numbers are exact, as decimals where they pass 64 bits.
    """
    phrases = settle(frequent_phrases(docs, text_col, lang_col, longest, min_found, fp_bits), "phrases")
    words = F.split("phrase", " ")

    def part(begin: Column, length: Column) -> Column:
        return F.array_join(F.slice(words, begin, length), " ")

    candidates = phrases.filter("size > 1").select("lang", "size", "phrase", F.col("found").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest")
    )
    parts = phrases.filter("size > 0")
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("found").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("found").alias("r"))
    square = _exact(F.col("a")) * _exact(F.col("a")) * F.lit(1_000_000).cast("decimal(7,0)")
    scored = (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .withColumn("divided", square)
        .withColumn("by", _exact(F.col("l")) * _exact(F.col("r")))
        .withColumn("score", F.expr("CAST(divided div by AS BIGINT)"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    inner = candidates.filter("size > 2").select(
        "lang",
        F.col("a").alias("around"),
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("size") - 1),
                    lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda b: part(b, n)),
                )
            )
        ).alias("phrase"),
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    own = (
        scored.join(inner, ["lang", "phrase"], "left")
        .filter(F.coalesce(100 * F.col("around") < within_percent * F.col("a"), F.lit(True)))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each part first, so that no language meets in one task.
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    best = own.withColumn("place", F.row_number().over(some)).filter(F.col("place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    sizes = phrases.filter("size = 0").select("lang", F.col("found").alias("n"))
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
