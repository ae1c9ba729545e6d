"""What several of the operators need: settled tables, row numbers, words."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.session import scratch_path

# A word of the contracts: a run of anything but ASCII white space. bytes.split() cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the folder that all executors share and read it back.

    This cuts the lineage: a lost executor costs no more than the tasks it ran, and whatever was
    not deterministic (row numbers, the order of a shuffle) is fixed from here on.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """rid, row: all columns in one struct, so that no name can clash, and a key that any later scan
    finds again.

    A row of a Parquet table is named by its file and place there, so that text need not be copied.
    Any other table is written first.
    """
    if not _plain_scan(docs):
        docs = settle(docs.select(F.struct("*").alias("row")), "rows")
        row = F.col("row")
    else:
        row = F.struct("*").alias("row")
    place = docs.metadataColumn("_metadata")
    return docs.select(F.struct(place["file_path"].alias("file"), place["row_index"].alias("at")).alias("rid"), row)


def _plain_scan(docs: DataFrame) -> bool:
    """Whether each row is one of a Parquet table, at most with columns and rows left out."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return False
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"]).schema  # noqa: B018
    except AnalysisException:
        return False
    return True


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The packed rows, unpacked, but those whose rid is in the other table.

    That is settled first: its size is then known, and Spark sends it to the tasks of the scan if it is
    small, rather than shuffle all texts.
    """
    return rows.join(settle(dropped.select("rid"), "dropped"), "rid", "left_anti").select("row.*")


def whole_text(column: str) -> F.Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def pieces(batches: Iterator, rows: int = 256) -> Iterator:
    """Cut Arrow batches into small ones, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
