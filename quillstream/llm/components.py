"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.shared import settle


def components(edges: DataFrame) -> DataFrame:
    """The smallest vertex that every vertex can reach.

    edges: two columns a, b of one orderable type, without nulls; loops and repeats do no harm.
    Returns vertex, root, one row per vertex that has an edge to another one.

    Alternating large and small stars: every round hangs each vertex's larger neighbours, then its
    smaller ones, on the smallest of them, until all edges are stars around the roots. Rounds grow
    with the logarithm of the longest path. A minimum is combined before it is shuffled and settled
    before it is joined, so that adaptive execution can split the join at a vertex with many edges.
    """
    links = settle(_larger_first(edges.select("a", "b")), "links")
    while not _all_stars(links):
        turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
        both = links.union(turned)
        large = _hang(both, both.filter("b > a"), "large")
        links = _hang(large, large, "small", own=True)
    roots = links.select(F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(
        roots.select(F.col("root").alias("vertex"), "root")
    )


def _all_stars(links: DataFrame) -> bool:
    """Whether every vertex that hangs on another has one edge only."""
    ends = links.select(F.col("a").alias("vertex"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select("b", F.lit(0), F.lit(1))
    )
    degrees = ends.groupBy("vertex").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return degrees.filter("up > 1 OR up = 1 AND down = 1").isEmpty()


def _larger_first(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _hang(around: DataFrame, moved: DataFrame, name: str, own: bool = False) -> DataFrame:
    """Hang the neighbours b of every a, and with own also a itself, on the smallest vertex around."""
    least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    least = settle(least.select(F.col("a").alias("centre"), "m"), f"{name}-least")
    hung = moved.join(least, F.col("a") == F.col("centre")).select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )
    if own:
        hung = hung.union(least.select(F.col("centre").alias("a"), F.col("m").alias("b")))
    return settle(_larger_first(hung), name)
