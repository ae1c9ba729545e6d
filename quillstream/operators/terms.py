"""Term statistics: hashed and exact term frequency, document frequency, TF-IDF."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.functions.arrays import map_runs
from quillstream.operators.rows import each

# A term table of at most this many bytes is broadcast; its size is measured by the fit.
BROADCAST_BYTES = 128 << 20
# What a row of a broadcast table takes beside its term and values.
ROW_OVERHEAD = 64
# A term with more than this share of all pairs is hot; there are at most HOT_TERMS of them.
HOT_TERMS = 4096
# A longer term is never broadcast as a hot one, which bounds these in bytes.
HOT_BYTES = 16 << 10


def hashed_term_frequency(items: DataFrame, buckets: int = 1 << 18) -> DataFrame:
    """Sparse vector raw_tf of the whitespace tokens."""
    return HashingTF(inputCol="tokens", outputCol="raw_tf", numFeatures=buckets).transform(items)


def term_counts(tokens: str) -> Column:
    """Distinct terms of a token array with their counts. A document is one row, so sorting its
    tokens and cutting the runs counts them without a shuffle."""
    count = "named_struct('term', get(run, 0), 'tf', cast(size(run) AS bigint))"
    return F.expr(map_runs(f"sort_array({tokens})", count))


def term_frequency(items: DataFrame, key: str = "id") -> DataFrame:
    """Exact counts: one row per item and distinct term. Narrow: no shuffle."""
    return each(items, term_counts("tokens"), "t", key).select(key, "t.term", "t.tf")


def document_frequency(items: DataFrame) -> DataFrame:
    """Number of items that hold each term. Map tasks add up first, so a term of every document
    reaches the shuffle as one row per task."""
    terms = each(items, F.array_distinct("tokens"), "term")
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf_weight(df: Column, n_docs: int) -> Column:
    return F.log(F.lit(n_docs + 1.0) / (df + F.lit(1.0)))


@dataclass(frozen=True)
class IdfTable:
    """A fitted IDF table: term, df and idf at a path, and the sizes that decide how to join it.
    n_pairs counts the pairs of item and distinct term: the sum of df."""

    path: str
    n_docs: int
    n_terms: int
    n_bytes: int
    n_pairs: int
    min_doc_freq: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def fit_idf(items: DataFrame, path: str, min_doc_freq: int = 0) -> IdfTable:
    """Compute IDF over a corpus once and write it as a table. Terms in fewer than ``min_doc_freq``
    items get weight 0 and are not stored."""
    return idf_table(document_frequency(items), items.count(), path, min_doc_freq)


def idf_table(frequencies: DataFrame, n_docs: int, path: str, min_doc_freq: int = 0) -> IdfTable:
    """The table from document frequencies that are known, and its sizes."""
    spark = frequencies.sparkSession
    frequencies = frequencies.where(F.col("df") >= min_doc_freq)
    frequencies.withColumn("idf", idf_weight(F.col("df"), n_docs)).write.parquet(path)
    # Terms can be of any length, so their number alone bounds no bytes.
    n_terms, letters, n_pairs = (
        spark.read.parquet(path)
        .agg(F.count(F.lit(1)), F.sum(F.octet_length("term")), F.sum("df"))
        .first()
    )
    n_bytes = (letters or 0) + n_terms * (16 + ROW_OVERHEAD)
    return IdfTable(path, n_docs, n_terms, n_bytes, n_pairs or 0, min_doc_freq)


def join_term_table(
    pairs: DataFrame, table: DataFrame, key: str, broadcast: bool, n_pairs: int = 0
) -> DataFrame:
    """Left join of (key, term) pairs with a one-row-per-term table, which also tells in ``n`` how
    many of ``n_pairs`` pairs held the term when it was made.

    A small table is broadcast. Of a large one only the hot terms are: at most HOT_TERMS, however
    large the table. Pairs that met theirs pass the shuffle under a key that no row of the table has, a
    hash of their own key, which spreads them evenly; a retried task repeats it.
    """
    values = [c for c in table.columns if c not in ("term", "n")]
    if broadcast:
        return pairs.join(F.broadcast(table.select("term", *values)), "term", "left")
    length = F.octet_length(F.col("term").cast("string"))
    hot = table.where((F.col("n") * HOT_TERMS >= n_pairs) & (length <= HOT_BYTES))
    known = F.struct(*values)
    met = F.col("hot_values").isNotNull()
    left = pairs.join(
        F.broadcast(hot.select("term", known.alias("hot_values"))), "term", "left"
    ).withColumns(
        {"wanted": F.when(~met, F.col("term")), "spread": F.when(met, F.xxhash64(key)).otherwise(F.lit(0))}
    )
    rest = table.select(
        F.col("term").alias("wanted"), F.lit(0).cast("long").alias("spread"), known.alias("cold_values")
    )
    joined = left.join(rest, ["wanted", "spread"], "left")
    found = F.coalesce("hot_values", "cold_values").alias("found")
    return joined.select(*pairs.columns, found).select(*pairs.columns, "found.*")


def met_terms(pairs: DataFrame, table: DataFrame) -> DataFrame | None:
    """The rows of a large term table whose terms the pairs hold; None where these are too many to broadcast."""
    met = pairs.select("term").distinct()
    n_terms, letters = met.agg(F.count(F.lit(1)), F.sum(F.octet_length("term"))).first()
    if (letters or 0) + n_terms * (16 + ROW_OVERHEAD) > BROADCAST_BYTES:
        return None
    return table.join(F.broadcast(met), "term", "left_semi")


def tf_idf(items: DataFrame, fitted: IdfTable, key: str = "id", batch: bool = False) -> DataFrame:
    """TF-IDF of every item and distinct term. A term the fit has not seen has document frequency 0,
    unless rare terms were cut off: then it counts as rare and gets 0.

    ``batch``: the items are a batch of a stream, few beside what the table was fitted on. Then a table too
    large to broadcast is read for the batch's terms only, and not shuffled for every batch."""
    unseen = math.log(fitted.n_docs + 1.0) if fitted.min_doc_freq <= 0 else 0.0
    pairs = term_frequency(items, key)
    table = fitted.read(items.sparkSession).select("term", F.col("df").alias("n"), "idf")
    broadcast = fitted.n_bytes <= BROADCAST_BYTES
    if batch and not broadcast and (met := met_terms(pairs, table)) is not None:
        table, broadcast = met, True
    joined = join_term_table(pairs, table, key, broadcast, fitted.n_pairs)
    weight = F.coalesce(F.col("idf"), F.lit(unseen))
    return joined.select(key, "term", "tf", (F.col("tf") * weight).alias("tf_idf"))
