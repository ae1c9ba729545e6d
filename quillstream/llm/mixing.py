"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.shared import WORD, packed, settle

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
TOLERANCE = 1e-6
BINS = 4096
# Documents of a source that give their copy to another one at the end.
SWAPS = 3


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null: the blanks that begin a word, counted without taking it apart."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered_sources(sources: DataFrame) -> DataFrame:
    """source, place: places from 0 in the order of code points, null last. Sorted by ranges, so that
    no task gets all; what precedes a range is summed over the ranges."""
    ordered = settle(
        sources.select("source")
        .distinct()
        .orderBy(F.col("source").asc_nulls_last())
        .select("source", F.monotonically_increasing_id().alias("rid")),
        "sources",
    ).withColumns({"part": F.shiftright("rid", 33), "row": F.expr("rid & 8589934591")})
    # One row per range.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.groupBy("part")
        .agg(F.count("*").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("start"))
    )
    return ordered.join(starts, "part").select("source", (F.col("row") + F.col("start")).alias("place"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """source, source_size and target, from source and source_size (one row per source).

    Sources share the sum of all sizes by weight; weights are given out in the order of code points,
    null last, over and over. No target is above most times its source: the excess is shared by
    weight among the others, until none is above.
    """
    numbered = numbered_sources(sizes)
    pick = F.array(*map(F.lit, weights))
    table = settle(
        sizes.join(_of(numbered, "source"), F.col("source").eqNullSafe(F.col("of"))).select(
            "source", "source_size", pick[(F.col("place") % len(weights)).cast("int")].cast("double").alias("weight")
        ),
        "source-weights",
    )
    total = float(table.agg(F.sum("source_size")).first()[0] or 0)
    limit = most * F.col("source_size")
    rate, capped = 0.0, 0
    while True:
        # A rate is words per weight; what full sources leave raises it, and so may fill others.
        full = limit <= rate * F.col("weight")
        kept, weight, count = table.agg(
            F.sum(F.when(full, limit).otherwise(0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
            F.sum(full.cast("long")),
        ).first()
        if rate and count == capped or not weight:
            break
        rate, capped = (total - kept) / weight, count
    target = F.least(limit.cast("double"), rate * F.col("weight")) if weight else limit.cast("double")
    return table.select("source", "source_size", target.alias("target"))


def dual_solution(histogram: DataFrame, targets: DataFrame, most: int = MAX_COPIES) -> DataFrame:
    """source, target, tilt, all: the solution of the convex dual of entropy balancing.

    Of all rates between 0 and most that give each source its target of words, those closest to 1 in
    relative entropy, document by document, are min(most, exp(tilt * size)): one tilt per source, at
    which the dual is flat. Newton's steps find it, halved into a bracket where they leave it; each is
    one aggregate over the histogram (source, size, n), which has no more rows than distinct sizes.
    all: the target takes every document most times.
    """
    mean = F.greatest(F.col("source_size").cast("double") / F.col("documents"), F.lit(1.0))
    shape = histogram.groupBy("source").agg(F.sum("n").alias("documents"), F.max("size").alias("largest"))
    state = _of(targets, "source").join(shape, F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "target", "source_size", mean.alias("unit"),
        (F.col("target") >= most * F.col("source_size")).alias("all"),
        # Tilts are per unit of mean size. Ends of the bracket are null until one is met.
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
        F.lit(0.0).alias("tilt"), F.lit(False).alias("done"),
    )
    state = settle(state, "tilts")
    size = F.col("size") / F.col("unit")
    power = F.least(F.lit(700.0), F.col("tilt") * size)
    rate = F.least(F.lit(float(most)), F.exp(power))
    inside = F.exp(power) < most
    while True:
        sums = _of(histogram, "source").join(
            state, F.col("source").eqNullSafe(F.col("of"))
        ).groupBy("source").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("mass"),
            F.sum(F.when(inside, F.col("n") * F.col("size") * size * rate).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("mass") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high"))
        most_step = 1 + F.abs("tilt")
        step = F.coalesce(gap / F.when(F.col("slope") > 0, F.col("slope")), F.signum(gap) * most_step)
        newton = F.col("tilt") - F.greatest(-most_step, F.least(most_step, step))
        inside_bracket = F.coalesce(newton > F.col("new_low"), F.lit(True)) & F.coalesce(
            newton < F.col("new_high"), F.lit(True)
        )
        # A bracket that can't be halved any more has no better tilt in it.
        middle = (low + high) / 2
        closed = F.coalesce((middle <= low) | (middle >= high), F.lit(False))
        done = F.col("all") | closed | (F.abs(gap) <= TOLERANCE * F.greatest(F.col("target"), F.lit(1.0)))
        state = settle(
            state.join(_of(sums, "source"), F.col("source").eqNullSafe(F.col("of")))
            .withColumns({"new_low": low, "new_high": high, "newly": done})
            .select(
                "source", "target", "source_size", "unit", "all", F.col("new_low").alias("low"),
                F.col("new_high").alias("high"),
                F.when(F.col("newly"), F.col("tilt"))
                .when(inside_bracket, newton)
                .otherwise((F.col("new_low") + F.col("new_high")) / 2)
                .alias("tilt"),
                F.col("newly").alias("done"),
            ),
            "tilts",
        )
        if state.filter("NOT done").isEmpty():
            break
    return state.select("source", "target", "source_size", "all", (F.col("tilt") / F.col("unit")).alias("tilt"))


def _rules(rows: DataFrame, tilts: DataFrame) -> DataFrame:
    """source, rules: which documents get one copy more, so that a source's words come to its target.

    A document turns over at its draw less its fraction. Those that turn over first get the copy,
    up to where the next one would take the source beyond its target; then, of the rest, those no
    larger than what is still missing, and so once more. At last a few documents give their copy to others,
    where that brings the words nearer. A rule is a threshold and a largest size.
    Words by turn are summed in BINS bins and, at first, again within the bin where the target
    falls: an aggregate each, whatever the number of documents.
    """
    sure = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("whole")).alias("sure"))
    state = _of(tilts, "source").join(sure, F.col("source").eqNullSafe(F.col("of"))).select(
        "source", (F.col("target") - F.col("sure")).alias("missing"), F.lit(-1.0).alias("low"),
        F.lit(3.0).alias("width"), F.lit(float("inf")).alias("limit"),
        F.array().cast("array<struct<shift:double,limit:double>>").alias("rules"),
    )
    state = settle(state, "mix-rules")
    candidates = rows.filter("fraction > 0 AND size > 0").select(F.col("source").alias("of"), "size", "turn")
    up_to = Window.partitionBy("of").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    step = F.col("width") / BINS
    for ends in (False, True, True, True):
        place = F.floor((F.col("turn") - F.col("low")) / step).cast("int")
        within = (F.col("turn") >= F.col("low")) & (place < BINS) & (F.col("size") <= F.col("limit"))
        running = (
            candidates.join(state, F.col("source").eqNullSafe(F.col("of")))
            .filter(within)
            .groupBy("of", place.alias("bin"))
            .agg(F.sum("size").alias("words"))
            .withColumn("taken", F.sum("words").over(up_to))
        )
        whole = F.col("taken") <= F.col("missing")
        fits = (
            state.join(running, F.col("source").eqNullSafe(F.col("of")), "left")
            .groupBy("source", "missing", "low", "width", "limit", "rules")
            .agg(
                F.coalesce(F.max(F.when(whole, F.col("taken"))), F.lit(0)).alias("taken"),
                F.min(F.when(~whole, F.col("bin"))).alias("next"),
            )
        )
        missing = F.col("missing") - F.col("taken")
        # The bin that goes beyond the target; the end of all bins if none does.
        at = F.coalesce(F.col("low") + F.col("next") * step, F.col("low") + F.col("width"))
        if ends:
            rule = F.struct(at.alias("shift"), F.col("limit"))
            changed = [(2.0 - at).alias("width"), missing.alias("limit"), F.array_append("rules", rule).alias("rules")]
        else:
            changed = [F.when(F.col("next").isNotNull(), step).otherwise(0.0).alias("width"), "limit", "rules"]
        state = settle(fits.select("source", missing.alias("missing"), at.alias("low"), *changed), "mix-rules")
    return _swapped(rows, state.select("source", "missing", "rules"))


def _more() -> Column:
    """Whether a document gets one copy more by the rules and swaps of its source."""
    ruled = F.exists("rules", lambda r: (F.col("turn") < r["shift"]) & (F.col("size") <= r["limit"]))

    def among(docs: str) -> Column:
        return F.exists(docs, lambda d: (F.col("size") == d["size"]) & (F.col("turn") == d["turn"]))

    # A document changes places once at most.
    return (F.col("fraction") > 0) & ((ruled & ~among("drops")) | among("adds"))


def _swapped(rows: DataFrame, state: DataFrame) -> DataFrame:
    """source, rules, drops and adds: SWAPS times, the document that gives up the copy that it got, and the one that
    gets it, so that what is missing comes nearest to 0 from either side; either may be nobody. No swap
    where none brings it nearer.

    Only sizes are compared, each once for those that got a copy and once for those that didn't, so a source
    has at most two rows for each distinct size, however many documents it has.
    """
    kind = "struct<size:bigint,turn:double>"
    none = F.array().cast(f"array<{kind}>")
    state = settle(state.withColumns({"drops": none, "adds": none}), "mix-swaps")
    candidates = rows.filter("fraction > 0 AND size > 0").select(F.col("source").alias("of"), "size", "turn", "fraction")
    nobody = F.expr("named_struct('size', 0L, 'turn', CAST(NULL AS DOUBLE))")
    for _ in range(SWAPS):
        joined = candidates.join(state, F.col("source").eqNullSafe(F.col("of")))
        touched = F.array_union("drops", "adds")
        untouched = ~F.exists(touched, lambda d: (F.col("size") == d["size"]) & (F.col("turn") == d["turn"]))
        sizes = (
            joined.filter(untouched)
            .groupBy("of", _more().alias("got"), "size")
            .agg(F.min("turn").alias("turn"), F.first("missing").alias("missing"))
            .select("of", "got", F.struct("size", "turn").alias("doc"), "missing")
        )
        ends = state.select(F.col("source").alias("of"), F.explode(F.array(F.lit(True), F.lit(False))).alias("got"), nobody.alias("doc"), "missing")
        wanted = F.col("doc.size") + F.when(F.col("got"), F.col("missing")).otherwise(0)
        other = F.when(~F.col("got"), F.col("doc"))
        by_size = Window.partitionBy("of").orderBy("wanted", "got")
        before = by_size.rowsBetween(Window.unboundedPreceding, -1)
        after = by_size.rowsBetween(1, Window.unboundedFollowing)
        pairs = (
            sizes.unionByName(ends)
            .withColumn("wanted", wanted)
            .withColumns({"below": F.last(other, True).over(before), "above": F.first(other, True).over(after)})
            .filter("got")
            .select("of", "missing", "wanted", F.col("doc").alias("drop"), F.explode(F.array("below", "above")).alias("add"))
            .filter("add IS NOT NULL")
            .withColumn("left", F.abs(F.col("wanted") - F.col("add.size")))
            .filter(F.col("left") < F.abs("missing"))
        )
        best = pairs.groupBy("of").agg(F.min(F.struct("left", "drop", "add", "wanted")).alias("best"))
        found = state.join(best, F.col("source").eqNullSafe(F.col("of")), "left")

        def grown(docs: str, which: str) -> Column:
            doc = F.col(f"best.{which}")
            return F.when(doc["turn"].isNotNull(), F.array_append(docs, doc)).otherwise(F.col(docs)).alias(docs)

        missing = F.coalesce(F.col("best.wanted") - F.col("best.add.size"), F.col("missing")).alias("missing")
        state = settle(found.select("source", missing, "rules", grown("drops", "drop"), grown("adds", "add")), "mix-swaps")
    return state.select("source", "rules", "drops", "adds")


def _of(table: DataFrame, column: str) -> DataFrame:
    """The table under another name for its key, to join it with one that has the same."""
    return table.withColumnRenamed(column, "of")


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MAX_COPIES,
) -> DataFrame:
    """How many copies of every document a mix of the sources takes.

    Returns one row per input row: rid, id, size (words), source_size, target (words that the source
    should give), rate (exponentially tilted), copies (0 to most, the rate rounded) and taken (copies
    times size). Rates are rounded by a draw from a hash of id and text, and the threshold of each
    source is set so that its words come near the target; a rerun on the same table gives the
    same. A document without words (null, empty or blank) keeps one copy and takes nothing; null sources
    are one source, the last; equal rows are drawn alike, rows with null ids apart; an empty table gives
    an empty result. Other columns are never looked at.

    The text is read once and never shuffled. Newton's iterations run over distinct (source, size)
    pairs, combined before the shuffle.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("text"),
    )
    rows = settle(_measured(rows), "mix-rows")
    return _decided(rows, _plan(rows, weights, most), most).select(
        "rid", "id", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def _measured(rows: DataFrame) -> DataFrame:
    """rid, id, source, size and draw (from 0 to 1) instead of the text; other columns stay."""
    # Rows without an id are told apart by their number. 53 bits of a hash of a hash are the draw.
    mark = F.xxhash64("id", "text", F.when(F.col("id").isNull(), F.col("rid")))
    draw = F.shiftrightunsigned(F.xxhash64(mark), 11) / F.lit(float(1 << 53))
    return rows.withColumns({"size": word_count(F.col("text")), "draw": draw}).drop("text")


def _rated(rows: DataFrame, tilts: DataFrame, most: int) -> DataFrame:
    """Rows with the plan's columns of their source, the rate, its whole part and fraction, and turn."""
    tilted = F.least(F.lit(float(most)), F.exp(F.least(F.lit(700.0), F.col("tilt") * F.col("size"))))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("all"), F.lit(float(most))).otherwise(tilted)
    return (
        rows.join(_of(tilts, "source"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("rate", rate)
        .withColumn("whole", F.floor("rate"))
        .withColumn("fraction", F.col("rate") - F.col("whole"))
        .withColumn("turn", F.col("draw") - F.col("fraction"))
        .drop("of")
    )


def _plan(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """What decides a source's copies, one row per source: source_size, target, tilt, all, rules."""
    histogram = settle(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-sizes")
    sizes = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    tilts = settle(dual_solution(histogram, source_targets(sizes, weights, most), most), "mix-tilts")
    rules = _rules(_rated(rows, tilts, most).select("source", "size", "whole", "fraction", "turn"), tilts)
    same = F.col("source").eqNullSafe(F.col("of"))
    return settle(tilts.join(_of(rules, "source"), same).drop("of"), "mix-plan")


def _decided(rows: DataFrame, plan: DataFrame, most: int) -> DataFrame:
    return _rated(rows, plan, most).withColumn("copies", (F.col("whole") + _more().cast("long")).cast("int"))


def mix_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MAX_COPIES,
) -> DataFrame:
    """The mix itself: every input row as often as it is taken, columns as they were.

    The table is read twice, to plan and to decide; a row needs only its source's plan, so no text is
    shuffled where the plans of all sources are small enough for Spark to send them to the scan.
    """
    rows = packed(docs)
    row = F.col("row")
    measured = _measured(
        rows.select(
            "rid", row.getField(id_col).alias("id"), row.getField(source_col).cast("string").alias("source"),
            row.getField(text_col).cast("string").alias("text"), "row",
        )
    )
    plan = _plan(settle(measured.drop("row", "rid", "id"), "mix-rows"), weights, most)
    decided = _decided(measured.select("source", "size", "draw", "row"), plan, most).filter("copies > 0")
    return decided.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
