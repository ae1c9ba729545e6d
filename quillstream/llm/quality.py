"""A quality classifier by Bradley-Terry ranking of document pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.words import chunks, coded_words, row_sums
from quillstream.session import scratch_path, ship_package

# Places on the scale of strengths between which the losses of all pairs are interpolated, and the fewer ones by
# which the curvature takes documents together.
GRID = 1 << 15
COARSE = 256
RIDGE = 1e-3
MOST_ROUNDS = 50
TOLERANCE = 1e-7
# Strengths that the driver sorts at most, to find the one of a rank.
SORTED = 10_000
# The score at the threshold strength, and how far scores spread around it.
CUT_SCORE = 0.3
FOLDS = 5

FEATURES = (
    "log_words", "mean_word", "longest_word", "upper_share", "digit_share", "symbol_share", "bar_share",
    "mark_share", "comma_share", "stop_share", "high_share", "byte_entropy", "distinct_share",
    "top_word_share", "echo_share", "echo_two_share", "dup_line_share", "mean_line", "short_word_share",
    "plain_word_share", "open_line_share", "blank_share",
)


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text, from nothing but the text; all zero for one without words."""
    texts = pc.fill_null(texts, "")
    rows = len(texts)
    words, codes, offsets = coded_words(texts)
    if "" in words:
        real = codes != words.index("")
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        codes = codes[real]
    n = np.diff(offsets)
    row = np.repeat(np.arange(rows), n)

    def per_word(values: list[int]) -> np.ndarray:
        table = np.array(values, dtype=np.int64)
        return row_sums(table[codes], offsets) if len(codes) else np.zeros(rows, np.int64)

    lengths = np.array([len(w) for w in words], dtype=np.int64)
    chars = per_word([len(w) for w in words])
    longest = np.zeros(rows, dtype=np.int64)
    if len(codes):
        np.maximum.at(longest, row, lengths[codes])
    histogram = np.zeros((rows, 256), dtype=np.int64)
    lines = np.zeros((rows, 3))
    for k, text in enumerate(texts.to_pylist()):
        data = text.encode("utf-8", "surrogatepass")
        for at in range(0, len(data), 1 << 22):
            part = np.frombuffer(data[at : at + (1 << 22)], dtype=np.uint8)
            histogram[k] += np.bincount(part, minlength=256)
        full = [line for line in data.split(b"\n") if line.strip()]
        still_open = sum(line.rstrip()[-1:] not in (b".", b"!", b"?", b":", b'"') for line in full)
        lines[k] = len(full), len(full) - len(set(full)), still_open

    def count(marks: bytes) -> np.ndarray:
        return histogram[:, list(marks)].sum(axis=1)

    upper, lower = count(bytes(range(65, 91))), count(bytes(range(97, 123)))
    total = np.maximum(histogram.sum(axis=1), 1)
    share = histogram / total[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    distinct, top = np.zeros(rows), np.zeros(rows)
    if len(codes):
        keys, found = np.unique(row * np.int64(len(words)) + codes, return_counts=True)
        of = keys // len(words)
        distinct = np.bincount(of, minlength=rows).astype(float)
        np.maximum.at(top, of, found)

    def echoes(step: int) -> np.ndarray:
        same = np.zeros(len(codes), dtype=np.int64)
        if len(codes) > step:
            same[step:] = (codes[step:] == codes[:-step]) & (row[step:] == row[:-step])
        return row_sums(same, offsets)

    some = np.maximum(n, 1)
    line_count = np.maximum(lines[:, 0], 1)
    high = histogram[:, 128:].sum(axis=1)
    columns = [
        np.log1p(n), chars / some, np.log1p(longest), upper / np.maximum(upper + lower, 1),
        count(b"0123456789") / total, count(b"#*$%&<>") / some, count(b"|") / some, count(b"!?") / some,
        count(b",;:") / some, count(b".") / some, high / total, entropy, distinct / some, top / some,
        echoes(1) / some, echoes(2) / some, lines[:, 1] / line_count, np.log1p(n / line_count),
        per_word([len(w) <= 3 for w in words]) / some, per_word([w.isalpha() for w in words]) / some,
        lines[:, 2] / line_count, count(b" \t\n\r\x0b\x0c") / total,
    ]
    return np.where((n > 0)[:, None], np.stack(columns, axis=1), 0.0)


@dataclass(frozen=True)
class Ranker:
    """Strengths by a linear score; the threshold is a quantile of strengths. share: of label 1."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float
    share: float

    def strength(self, values: np.ndarray) -> np.ndarray:
        return np.clip((values - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, values: np.ndarray) -> np.ndarray:
        """From 0 to 1, CUT_SCORE at the threshold; the share of label 1 for a model without pairs."""
        if not self.weights.any():
            return np.full(len(values), self.share)
        start = np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.strength(values) - self.cut) + start, -30, 30)))


def _totals(rows: DataFrame, add: Callable[[np.ndarray, np.ndarray, np.ndarray], None], size: int) -> np.ndarray:
    """The sum over all rows of ``size`` numbers, which ``add`` adds to an array from features and labels. A task
    sends that many at most, however many rows it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                add(_values(batch), batch.column("label").to_numpy(), total)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met])], ["place", "x"])

    total = np.zeros(size)
    for row in rows.mapInArrow(run, "place long, x double").groupBy("place").agg(F.sum("x").alias("x")).collect():
        total[row["place"]] = row["x"]
    return total


def _values(batch: pa.RecordBatch) -> np.ndarray:
    return pc.list_flatten(batch.column("features")).to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _losses(counts: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray]:
    """For documents at each place of the grid: how often, as a sum of probabilities, they lose against those
    counted at all places, and the derivative of that."""
    gaps = np.arange(-(GRID - 1), GRID) * step
    odds = 1 / (1 + np.exp(np.clip(gaps, -500, 500)))
    n = 4 * GRID
    of = np.fft.rfft(counts, n)

    def met(kernel: np.ndarray) -> np.ndarray:
        return np.fft.irfft(of * np.fft.rfft(kernel, n), n)[GRID - 1 : 2 * GRID - 1]

    return met(odds), met(odds * (1 - odds))


def fit_pairs(rows: DataFrame, pairs: tuple[int, int], ridge: float = RIDGE) -> Ranker:
    """Fit strengths so that a good document beats a bad one: the mean logistic loss of all pairs of a good and a
    bad document, by Newton's method. ``rows`` holds features and label of every document, ``pairs`` the numbers
    of good and bad ones. The threshold is the strength below which as many documents lie as have label 0.

    A document's part in the gradient depends only on its strength and on those of the other label. So a round
    counts the strengths of both labels on a grid, and then adds up the documents by what the grid tells of all
    their pairs: two aggregates, in proportion to the documents and not to the pairs.
    """
    width = len(FEATURES)
    n_good, n_bad = pairs
    share = n_good / (n_good + n_bad) if n_good + n_bad else 0.5
    none = Ranker(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0, share)
    if not n_good or not n_bad:
        return none

    def add_values(x: np.ndarray, label: np.ndarray, total: np.ndarray) -> None:
        total += x.sum(axis=0)

    mean = _totals(rows, add_values, width) / (n_good + n_bad)

    def add_squares(x: np.ndarray, label: np.ndarray, total: np.ndarray) -> None:
        total += ((x - mean) ** 2).sum(axis=0)

    scale = np.maximum(np.sqrt(_totals(rows, add_squares, width) / (n_good + n_bad)), 1e-6)

    def scaled(x: np.ndarray) -> np.ndarray:
        return np.clip((x - mean) / scale, -8, 8)

    weights = np.zeros(width)
    for _ in range(MOST_ROUNDS):
        # No strength is beyond this.
        most = max(8 * np.abs(weights).sum(), 1.0)
        step = 2 * most / (GRID - 2)

        def placed(z: np.ndarray, weights=weights, most=most, step=step) -> tuple[np.ndarray, np.ndarray]:  # noqa: ANN001
            at = (z @ weights + most) / step
            low = np.clip(at.astype(np.int64), 0, GRID - 2)
            return low, at - low

        def add_places(x: np.ndarray, label: np.ndarray, total: np.ndarray, placed=placed) -> None:  # noqa: ANN001
            low, part = placed(scaled(x))
            first = np.where(label == 1, 0, GRID) + low
            np.add.at(total, first, 1 - part)
            np.add.at(total, first + 1, part)

        counts = _totals(rows, add_places, 2 * GRID).reshape(2, GRID)
        # Against the bad for a good one, against the good (the other way round) for a bad one.
        good_loss, good_curve = _losses(counts[1], step)
        bad_loss, bad_curve = (v[::-1] for v in _losses(counts[0][::-1], step))
        tables = np.stack([good_loss, bad_loss, good_curve, bad_curve]) / (n_good * n_bad)

        def add_sums(x: np.ndarray, label: np.ndarray, total: np.ndarray, placed=placed, tables=tables) -> None:  # noqa: ANN001
            z = scaled(x)
            low, part = placed(z)
            of = np.where(label == 1, 0, 1)
            loss, curve = (
                tables[k + of, low] * (1 - part) + tables[k + of, low + 1] * part for k in (0, 2)
            )
            total[:width] += np.where(of == 0, -loss, loss) @ z
            total[width : width + width * width] += ((z * curve[:, None]).T @ z).ravel()
            bins = (of * COARSE + low * COARSE // GRID)[:, None] * width + np.arange(width)
            np.add.at(total, width + width * width + bins, z)

        sums = _totals(rows, add_sums, width + width * width + 2 * COARSE * width)
        gradient = sums[:width] + ridge * weights
        good, bad = sums[width + width * width :].reshape(2, COARSE, width)
        gaps = (np.arange(COARSE)[:, None] - np.arange(COARSE)) * (step * GRID / COARSE)
        odds = 1 / (1 + np.exp(np.clip(gaps, -500, 500)))
        across = good.T @ (odds * (1 - odds)) @ bad / (n_good * n_bad)
        curve = sums[width : width + width * width].reshape(width, width) - across - across.T
        # Taken together by strength, pairs may seem to curve the other way a little.
        values, vectors = np.linalg.eigh((curve + curve.T) / 2)
        change = vectors @ ((vectors.T @ gradient) / (np.maximum(values, 0) + ridge))
        change *= min(1.0, 4.0 / max(np.linalg.norm(change), 1e-12))
        weights = weights - change
        if np.abs(change).max() < TOLERANCE:
            break

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                strength = pa.array(scaled(_values(batch)) @ weights)
                yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.int32()), strength], ["label", "s"])

    spark = rows.sparkSession
    stored = scratch_path(spark, "strengths")
    rows.mapInArrow(run, "label int, s double").write.parquet(stored)
    strengths = spark.read.parquet(stored)
    cut = (_of_rank(strengths, n_bad - 1) + _of_rank(strengths, n_bad)) / 2
    good, bad = (
        (_of_rank(own, (n - 1) // 2) + _of_rank(own, n // 2)) / 2
        for own, n in ((strengths.where("label = 1"), n_good), (strengths.where("label = 0"), n_bad))
    )
    return Ranker(mean, scale, weights, cut, 8.0 / max(good - bad, 1e-6), share)


def _of_rank(strengths: DataFrame, rank: int) -> float:
    """The strength of a rank, from 0: counted by bins of equal width, then within the bin that holds it, until
    the driver can sort what is left."""
    low, high, n = strengths.agg(F.min("s"), F.max("s"), F.count("s")).first()
    while low < high and n > SORTED:
        inside = strengths.where(F.col("s").between(low, high))
        place = F.least(F.floor((F.col("s") - low) / (high - low) * 4096), F.lit(4095)).alias("bin")
        found = inside.groupBy(place).agg(F.min("s").alias("low"), F.max("s").alias("high"), F.count("s").alias("n"))
        for row in found.orderBy("bin").collect():
            if rank < row["n"]:
                break
            rank -= row["n"]
        low, high, n = row["low"], row["high"], row["n"]
    if low == high:
        return low
    return sorted(r["s"] for r in strengths.where(F.col("s").between(low, high)).collect())[rank]


def fold(column: str) -> Column:
    """crc32 of the id as text, modulo FOLDS; 0 for a null id, which no label refers to."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % FOLDS


def fit_ranker(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Ranker:
    """Fit on all labelled documents outside the held-out fold. A null label counts for nothing; of several
    labels of a document the smallest counts."""
    spark = docs.sparkSession
    ship_package(spark)
    known = (
        labels.filter(F.col(label_col).isin(0, 1) & (fold(id_col) != 0))
        .groupBy(F.col(id_col).alias("of"))
        .agg(F.min(label_col).alias("label"))
    )
    texts = docs.where(fold(id_col) != 0).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            values = features(chunk.column("text"))
            ends = np.arange(chunk.num_rows + 1, dtype=np.int32) * values.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([chunk.column("id"), lists], ["id", "features"])

    # Features are joined, not texts: a tenth of their bytes.
    schema = texts.select("id", F.array(F.lit(0.0)).alias("features")).schema
    found = texts.mapInArrow(run, schema).join(known, F.col("id") == F.col("of"))
    # One row for each id, however often a document is repeated.
    stored = scratch_path(spark, "labelled-features")
    found.groupBy("of", "label").agg(F.min("features").alias("features")).write.parquet(stored)
    rows = spark.read.parquet(stored).select("features", "label")
    met = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    return fit_pairs(rows, (met.get(1, 0), met.get(0, 0)))


def quality_scores(
    docs: DataFrame, ranker: Ranker, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, held_out, score and predicted (1 from CUT_SCORE on) for every row.

    Null and empty texts have all features zero and get that score; null ids stay null; repeated
    rows score alike; an empty table gives an empty result. Only the text is an input of the score.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).alias("id"), (fold(id_col) == 0).alias("held_out"), F.col(text_col).cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            scores = ranker.score(features(chunk.column("text")))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("id"), chunk.column("held_out"), pa.array(scores)], ["id", "held_out", "score"]
            )

    schema = texts.select("id", "held_out", F.lit(0.0).alias("score")).schema
    scored = texts.mapInArrow(run, schema)
    return scored.withColumn("predicted", F.when(F.col("score") >= CUT_SCORE, 1).otherwise(0))
