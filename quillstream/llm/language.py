"""Language identification by Bayesian fusion of text, markup, address and host."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.shared import packed, settle, without
from quillstream.llm.words import chunks
from quillstream.session import ship_package

BUCKETS = 1 << 14
# Distinct labelled texts of each language that the text model is fitted on, about.
ROWS_PER_LANGUAGE = 500
# Up to so many languages the model is a table in every task (8 MB); beyond, a DataFrame that is joined.
MANY_LANGUAGES = 64
# A list of labels and shares that is smaller goes to all tasks of the scan for the sample.
LISTED_BYTES = 4 << 20
# Three letters in a row overlap with their neighbours: each counts as a third of a fact.
TEMPER = 1 / 3
# Documents that a prior of the level above is worth.
PRIOR_WEIGHT = 20.0
MIN_CONFIDENCE = 0.5
UNKNOWN = "und"

# ASCII letters and the bytes of all other characters stay; anything else parts words.
LETTERS = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in range(256))
TRIGRAM_BYTES = 1 << 20


def _trigrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text number of every trigram that has no two blanks in a row, some at a time."""
    for number, text in enumerate(texts):
        data = b" " + text.lower().encode("utf-8", "surrogatepass").translate(LETTERS) + b" "
        for start in range(0, len(data) - 2, TRIGRAM_BYTES):
            part = np.frombuffer(data[start : start + TRIGRAM_BYTES + 2], dtype=np.uint8).astype(np.uint32)
            blank = part == 32
            real = ~((blank[:-2] & blank[1:-1]) | (blank[1:-1] & blank[2:]))
            mixed = (part[:-2] * 0x9E3779B1 + part[1:-1] * 0x85EBCA77 + part[2:] * 0xC2B2AE3D).astype(np.uint32)
            yield (mixed >> 18)[real], np.int64(number)


@dataclass(frozen=True)
class TextModel:
    """Log-likelihoods of trigram buckets for every label there is, and for UNKNOWN, the last one, where all
    buckets are equally likely: text that is unlike every known language falls to it.

    unseen: by language, of a bucket that was not met in it. weights: k (place of the language), bucket and
    weight, what a bucket that was met adds to that. table: both in one, a row for each language, if there are at most
    MANY_LANGUAGES.
    """

    languages: tuple[str, ...]
    unseen: np.ndarray
    weights: DataFrame | None
    table: np.ndarray | None


def _log_likelihoods(table: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """By text and language, tempered; and how many trigrams each text has."""
    sums = np.zeros((len(texts), len(table)))
    counts = np.zeros(len(texts), dtype=np.int64)
    for buckets, number in _trigrams(texts):
        times = np.bincount(buckets, minlength=BUCKETS) if len(buckets) > BUCKETS else None
        sums[number] += table @ times if times is not None else table[:, buckets].sum(axis=1)
        counts[number] += len(buckets)
    return sums * TEMPER, counts


def _bucket_counts(rows: DataFrame, key: str) -> DataFrame:
    """key, bucket and n: the trigrams of the column text of all rows with that key, not yet added up over
    batches. key is a number. Only buckets that are met are held, and handed on before they become many."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(keys: list[np.ndarray], of: np.ndarray) -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(keys), return_counts=True)
            arrays = [of[pairs // BUCKETS], pairs % BUCKETS, n]
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in arrays], [key, "bucket", "n"])

        for chunk in chunks(batches):
            of, place = np.unique(chunk.column(key).to_numpy(zero_copy_only=False), return_inverse=True)
            keys, held = [], 0
            for buckets, number in _trigrams(pc.fill_null(chunk.column("text"), "").to_pylist()):
                keys.append(place[number] * BUCKETS + buckets.astype(np.int64))
                held += len(buckets)
                if held >= 4 * TRIGRAM_BYTES:
                    yield counted(keys, of)
                    keys, held = [], 0
            if keys:
                yield counted(keys, of)

    return rows.select(F.col(key).cast("long").alias(key), "text").mapInArrow(run, f"{key} long, bucket long, n long")


def fit_text_model(
    docs: DataFrame,
    text_col: str = "text",
    label_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    smoothing: float = 0.5,
) -> TextModel:
    """Count trigrams of a sample of about rows_per_language distinct labelled texts for every label, chosen by
    a hash of the text. No label at all leaves UNKNOWN. The driver gets two numbers for each label, and
    the counts only if there are at most MANY_LANGUAGES."""
    texts = docs.select(
        F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label")
    ).filter("text IS NOT NULL AND label IS NOT NULL")
    # Copies of a text count once, so that a label of many copies has a sample as well.
    labels = texts.groupBy("label").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()
    shares = {r["label"]: min(1.0, rows_per_language / max(r["n"], 1)) for r in labels}
    languages = tuple(sorted(shares))
    size = len(languages)
    flat = -np.log(BUCKETS)
    if not languages:
        return TextModel((UNKNOWN,), np.array([flat]), None, np.full((1, BUCKETS), flat))
    listed = docs.sparkSession.createDataFrame(
        [(k, place, shares[k]) for place, k in enumerate(languages)], "of string, k long, share double"
    )
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.col("share") * (1 << 20)
    if size * 16 + sum(map(len, languages)) <= LISTED_BYTES:
        listed = F.broadcast(listed)
    sample = texts.join(listed, F.col("label") == F.col("of")).filter(drawn).select("k", "text").distinct()
    counts = settle(
        _bucket_counts(sample, "k").groupBy("k", "bucket").agg(F.sum("n").alias("n")), "trigrams-of-languages"
    )
    totals = np.zeros(size)
    for r in counts.groupBy("k").agg(F.sum("n").alias("n")).collect():
        totals[r["k"]] = r["n"]
    unseen = np.append(np.log(smoothing) - np.log(totals + smoothing * BUCKETS), flat)
    weights = counts.select("k", "bucket", F.log((F.col("n") + smoothing) / smoothing).alias("weight"))
    table = None
    if size <= MANY_LANGUAGES:
        found = weights.toArrow()
        table = np.repeat(unseen[:, None], BUCKETS, axis=1)
        places = found.column("k").to_numpy(), found.column("bucket").to_numpy()
        table[places] += found.column("weight").to_numpy()
    return TextModel((*languages, UNKNOWN), unseen, weights, table)


def _text_evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """rows has rid, id, text and columns of other evidence; text becomes loglik and trigrams."""
    return _looked_up(rows, model.table) if model.table is not None else _joined_evidence(rows, model)


def _looked_up(rows: DataFrame, table: np.ndarray) -> DataFrame:
    others = [c for c in rows.columns if c != "text"]
    spark = rows.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(table)  # at most MANY_LANGUAGES + 1 rows of BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            texts = pc.fill_null(chunk.column("text"), "").to_pylist()
            sums, counts = _log_likelihoods(shared.value, texts)
            yield pa.RecordBatch.from_arrays(
                [chunk.column(c) for c in others]
                + [pa.array(list(sums), pa.list_(pa.float64())), pa.array(counts)],
                [*others, "loglik", "trigrams"],
            )

    schema = rows.select(
        *others, F.array(F.lit(0.0)).alias("loglik"), F.lit(0).cast("long").alias("trigrams")
    ).schema
    return settle(rows.select(*others, "text").mapInArrow(run, schema), "text-evidence")


def _joined_evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """The same for any number of languages: buckets of the texts meet the weights by a join, and are summed up
    by text and language. Nothing but a number for each language is in the driver or in all tasks."""
    others = [c for c in rows.columns if c != "text"]
    # Row numbers and structs become one number each, which the parts of a text are added up by.
    numbered = settle(rows.withColumn("at", F.monotonically_increasing_id()), "numbered-texts")
    buckets = settle(_bucket_counts(numbered, "at"), "buckets-of-texts")
    sums = buckets.join(model.weights, "bucket").groupBy("at", "k").agg(F.sum(F.col("n") * F.col("weight")).alias("s"))
    by_text = sums.groupBy("at").agg(F.map_from_entries(F.collect_list(F.struct("k", "s"))).alias("sums"))
    lengths = buckets.groupBy("at").agg(F.sum("n").alias("n"))
    unseen = F.transform(F.array(*map(F.lit, model.unseen.tolist())), lambda u, k: F.struct(u.alias("u"), k.alias("k")))
    met = F.coalesce("sums", F.create_map().cast("map<bigint,double>"))
    trigrams = F.coalesce("n", F.lit(0)).cast("long")
    scored = (
        numbered.drop("text")
        .join(lengths, "at", "left")
        .join(by_text, "at", "left")
        .select(
            *others,
            F.transform(
                unseen,
                lambda e: (e["u"] * trigrams + F.coalesce(F.try_element_at(met, e["k"].cast("long")), F.lit(0.0))) * TEMPER,
            ).alias("loglik"),
            trigrams.alias("trigrams"),
        )
    )
    return settle(scored, "text-evidence")


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def _added(one: Column, other: Column) -> Column:
    return F.zip_with(one, other, lambda a, b: a + b)


def _sums(rows: DataFrame, by: list[str], size: int) -> DataFrame:
    """Expected documents of each language, n and the sums as array, by group."""
    if size > MANY_LANGUAGES:
        # Posteriors of nothing add nothing, and are most of them.
        each = rows.select(*by, F.posexplode("posterior").alias("k", "p")).filter("p > 0").groupBy(*by, "k")
        pairs = F.collect_list(F.struct("k", "p"))
        entries = each.agg(F.sum("p").alias("p")).groupBy(*by).agg(F.map_from_entries(pairs).alias("by_k"))
        filled = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.coalesce(F.col("by_k")[k], F.lit(0.0)))
        grouped = rows.groupBy(*by).agg(F.count("*").alias("n"))
        right = entries.select(*[F.col(k).alias(f"with_{k}") for k in by], filled.alias("sums"))
        same = F.lit(True)
        for k in by:
            same &= F.col(k).eqNullSafe(F.col(f"with_{k}"))
        flat = F.array_repeat(F.lit(0.0), size)
        return grouped.join(right, same, "left").select(*by, "n", F.coalesce("sums", flat).alias("sums"))
    sums = [F.sum(F.col("posterior")[k]).alias(f"s{k}") for k in range(size)]
    grouped = rows.groupBy(*by).agg(F.count("*").alias("n"), *sums)
    return grouped.select(*by, "n", F.array(*[F.col(f"s{k}") for k in range(size)]).alias("sums"))


def _joined(rows: DataFrame, table: DataFrame, keys: list[str], value: str, otherwise: Column) -> DataFrame:
    right = table.select(*[F.col(k).alias(f"of_{k}") for k in keys], F.col(value).alias("found"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"of_{k}"))
    joined = rows.join(right, same, "left").drop(*[f"of_{k}" for k in keys])
    return joined.withColumn(value, F.coalesce("found", otherwise)).drop("found")


def _identify(rows: DataFrame, model: TextModel, evidence: list[str], levels: list[str], weight: float) -> DataFrame:
    size = len(model.languages)
    flat = F.array(*[F.lit(0.0)] * size)
    scored = _text_evidence(rows, model)
    # A text without letters says nothing, neither here nor in the counts below.
    soft = scored.withColumn("posterior", _softmax(F.col("loglik")))
    spoken = soft.filter("trigrams > 0")
    whole = _sums(spoken, [], size).first()
    total = whole["n"]
    sums = [s or 0.0 for s in whole["sums"]]
    prior = [(s + 1.0) / (total + size) for s in sums]

    # Each level's prior leans on the one above: all documents, domain, host within the domain.
    scored = scored.withColumn("prior", F.array(*map(F.lit, prior)))
    for depth in range(1, len(levels) + 1):
        by = levels[:depth]
        counts = _sums(spoken, by, size)
        if depth == 1:
            above = F.array(*map(F.lit, prior))
        else:
            counts = _joined(counts, table, levels[: depth - 1], "prior", F.array(*map(F.lit, prior)))  # noqa: F821
            above = F.col("prior")
        smoothed = F.zip_with(F.col("sums"), above, lambda s, p: (s + weight * p))
        table = settle(
            counts.select(*by, F.transform(smoothed, lambda x: x / (F.col("n") + weight)).alias("prior")),
            f"prior-{depth}",
        )
    if levels:
        scored = _joined(scored.drop("prior"), table, levels, "prior", F.array(*map(F.lit, prior)))
    logs = _added(F.col("loglik"), F.transform("prior", lambda x: F.ln(x)))
    # How often a language goes with a declared value, against how often the value is met at all.
    for column in evidence:
        counts = _sums(spoken.filter(F.col(column).isNotNull()), [column], size)
        given = F.zip_with(
            F.col("sums"),
            F.array(*map(F.lit, sums)),
            lambda s, t: F.log((s + weight * F.col("n") / max(total, 1)) / (t + weight)),
        )
        table = settle(counts.select(column, given.alias(f"given_{column}")), f"given-{column}")
        scored = _joined(scored, table, [column], f"given_{column}", flat)
        logs = _added(logs, F.col(f"given_{column}"))
    names = F.array(*map(F.lit, model.languages))
    fused = scored.select("rid", "id", "trigrams", _softmax(logs).alias("posterior")).select(
        "rid",
        "id",
        F.when(F.col("trigrams") > 0, names[F.array_position("posterior", F.array_max("posterior")).cast("int") - 1])
        .otherwise(UNKNOWN)
        .alias("language"),
        F.when(F.col("trigrams") > 0, F.array_max("posterior")).otherwise(0.0).alias("confidence"),
    )
    return fused


def identify_languages(
    docs: DataFrame,
    model: TextModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared_col: str | None = "lang",
    suffix_col: str | None = None,
    domain_col: str | None = None,
    host_col: str | None = "source",
    prior_weight: float = PRIOR_WEIGHT,
    min_confidence: float = MIN_CONFIDENCE,
    accepted: tuple[str, ...] | None = None,
) -> DataFrame:
    """The language of every row, from all evidence at once.

    The text gives likelihoods of its letters (whole texts). The declared language and the suffix of
    the address count as often as texts of each language go with them in this table. Hosts give priors,
    smoothed towards their domain's and these towards all documents'. A column that is None is not
    used; a null value in it says nothing, and rows with a null host are one host.

    Returns one row per input row: rid, id, language, confidence, kept. Rejected: UNKNOWN (no letters,
    a null or empty text, or text unlike every language), confidence below min_confidence, or a
    language that is not accepted. If the model knows no language at all, the declared one is taken without
    confidence, and whatever has letters is kept unless its declared language is not accepted. Null ids stay null, repeated rows get equal results, an empty table
    gives an empty result; other columns are never looked at.

    The table is read once; what follows works on a few numbers per row. Groups are combined before the
    shuffle, and joins at a large host are split by adaptive execution.
    """
    others = {"declared": declared_col, "suffix": suffix_col, "domain": domain_col, "host": host_col}
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        *[F.col(c).cast("string").alias(k) for k, c in others.items() if c],
    )
    return _verdicts(rows, model, others, prior_weight, min_confidence, accepted)


def _verdicts(rows, model, others, prior_weight, min_confidence, accepted) -> DataFrame:
    evidence = [k for k in ("declared", "suffix") if others[k]]
    levels = [k for k in ("domain", "host") if others[k]]
    if model.languages == (UNKNOWN,):
        return _declared_alone(rows, model, "declared" in evidence, accepted)
    found = _identify(rows, model, evidence, levels, prior_weight)
    kept = (F.col("language") != UNKNOWN) & (F.col("confidence") >= min_confidence)
    if accepted is not None:
        kept &= F.col("language").isin(*accepted)
    return found.withColumn("kept", kept)


def _declared_alone(rows: DataFrame, model: TextModel, declared: bool, accepted: tuple[str, ...] | None) -> DataFrame:
    """Verdicts where no text model could be fitted: the declared language if there is one, and every text
    with letters passes, as nothing speaks against it."""
    scored = _text_evidence(rows, model)
    spoken = F.col("trigrams") > 0
    named = F.coalesce("declared", F.lit(UNKNOWN)) if declared else F.lit(UNKNOWN)
    language = F.when(spoken, named).otherwise(UNKNOWN)
    kept = spoken
    if accepted is not None:
        kept &= (F.col("language") == UNKNOWN) | F.col("language").isin(*accepted)
    found = scored.select("rid", "id", "trigrams", language.alias("language"), F.lit(0.0).alias("confidence"))
    return found.withColumn("kept", kept).drop("trigrams")


def keep_identified(
    docs: DataFrame,
    model: TextModel,
    text_col: str = "text",
    declared_col: str | None = "lang",
    host_col: str | None = "source",
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """The input rows, columns as they were, without those that identification rejects."""
    rows = packed(docs)
    row = F.col("row")
    others = {"declared": declared_col, "suffix": None, "domain": None, "host": host_col}
    texts = rows.select(
        "rid",
        F.lit(None).cast("long").alias("id"),
        row.getField(text_col).cast("string").alias("text"),
        *[row.getField(c).cast("string").alias(k) for k, c in others.items() if c],
    )
    return without(rows, _verdicts(texts, model, others, PRIOR_WEIGHT, min_confidence, None).filter("NOT kept"))


def markup_language(html: str) -> Column:
    """The primary language that a page declares in its html element, null if none."""
    found = F.regexp_extract(html, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2,3})\b", 1)
    return F.nullif(F.lower(found), F.lit(""))


def address_host(url: str) -> Column:
    return F.lower(F.try_parse_url(F.col(url), F.lit("HOST")))


def address_suffix(url: str) -> Column:
    """The last label of the host, and a first path segment of two letters if there is one."""
    host = F.element_at(F.split(address_host(url), r"\."), -1)
    path = F.regexp_extract(F.coalesce(F.try_parse_url(F.col(url), F.lit("PATH")), F.lit("")), r"^/([a-z]{2})(?:/|$)", 1)
    return F.concat_ws("/", host, F.nullif(path, F.lit("")))


def address_domain(url: str) -> Column:
    """The last two labels of the host."""
    return F.substring_index(address_host(url), ".", -2)


def page_text(html: str) -> Column:
    """A page without comments, scripts, styles and tags."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&[a-zA-Z]+;|&#\d+;", " ")
