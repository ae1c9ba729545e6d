"""Secrets by patterns, and by Markov models of random strings and ordinary identifiers."""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.shared import whole_text

# Kind, pattern, length that a hit must have at least (assign: of group 2). Java and RE2 read them alike.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
MIN_LENGTH = {"assign": 6, "access": 20, "hex": 24}

# What the models judge: a whole run of these characters, with or without digits, of this length at least.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_RUN = 8
RUN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{MIN_RUN},}}+"
HINT = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
# Two neighbours in a run; nothing is used up, so that pairs overlap.
PAIR = r"(?=([A-Za-z0-9+/_=-]{2}))"
# Log-likelihood ratio, in nats per pair of characters, from which a run is a secret.
MIN_RATIO = 1.0
SMOOTHING = 0.5


def located(text: Column, pattern: str, kind: str) -> Column:
    """All leftmost matches that don't overlap: kind, start, end (code points, end exclusive), value.

    Spark gives matches without places. What lies between them comes from a split at the same pattern;
    running sums of both lengths give the places, in n log n of the matches.
    """
    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: _placed(text, pattern, kind, hits))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is worked out once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def running_sums(numbers: Column) -> Column:
    """Running totals of an array, by doubling: after step k each place holds the sum of the 2^(k+1) numbers
    that end with it."""
    steps = F.transform(
        F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(1)))).cast("int")),
        lambda k: F.pow(F.lit(2.0), k).cast("int"),
    )
    return F.aggregate(
        steps, numbers, lambda sums, step: F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - step), F.lit(0)))
    )


def _placed(text: Column, pattern: str, kind: str, hits: Column) -> Column:
    """The matches with their places."""

    def spans(gaps: Column) -> Column:
        lengths = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda gap, hit: F.length(gap) + F.length(hit))
        return _let(
            running_sums(lengths),
            lambda ends: F.zip_with(
                hits,
                ends,
                lambda hit, end: F.struct(
                    F.lit(kind).alias("kind"), (end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("value")
                ),
            ),
        )

    return F.when(F.size(hits) > 0, _let(F.split(text, pattern, -1), spans)).otherwise(F.array().cast(_SPANS))


_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def base_spans(text: Column) -> Column:
    """Spans of the three patterns that are long enough, in the order of KINDS."""
    assigned = F.filter(
        located(text, ASSIGN, "assign"),
        lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= MIN_LENGTH["assign"],
    )
    longer = [
        # A run shorter than asked for is no hit, and runs are as long as can be: ask at once.
        located(text, ACCESS[:-1] + f"{{{MIN_LENGTH['access'] - 4},}}", "access"),
        located(text, HEX[:-1] + f"{{{MIN_LENGTH['hex']},}}", "hex"),
    ]
    return F.concat(assigned, *longer)


def pair_counts(samples: DataFrame) -> DataFrame:
    """secret, pair, n: how often a character of ALPHABET follows another in the values of each kind.

    Counts are combined before the shuffle, which thus sees two numbers for each pair and task, however
    many values or however long ones there are."""
    pairs = F.explode(F.regexp_extract_all("value", F.lit(PAIR), F.lit(1)))
    return samples.select("secret", pairs.alias("pair")).groupBy("secret", "pair").agg(F.count("*").alias("n"))


def bigram_table(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios by pair of characters, from labelled samples (value, secret).

    A first-order model of each kind: how often a character follows another, smoothed towards all being
    alike. The table has one row and one column for each character of ALPHABET.
    """
    size = len(ALPHABET)
    counts: dict[bool, dict[str, int]] = {True: {}, False: {}}
    for row in pair_counts(samples).collect():  # at most two numbers for each pair of characters
        counts[row["secret"]][row["pair"]] = row["n"]
    ratios = []
    for a in ALPHABET:
        rows = {k: [counts[k].get(a + b, 0) + SMOOTHING for b in ALPHABET] for k in (True, False)}
        totals = {k: sum(v) for k, v in rows.items()}
        ratios += [log(rows[True][j] / totals[True]) - log(rows[False][j] / totals[False]) for j in range(size)]
    return ratios


def labelled_samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """value, secret: all values that the patterns found, and the whole of every text that has nothing
    of the kind. Digits and signs of ALPHABET are ordinary in it as letters are."""
    texts = docs.select(whole_text(text_col).alias("text"))
    hinted = F.col("text").rlike(HINT)
    span = F.explode(base_spans(F.col("text"))).alias("span")
    value = F.when(F.col("span.kind") == "assign", F.regexp_extract("span.value", ASSIGN, 2)).otherwise(
        F.col("span.value")
    )
    secrets = texts.filter(hinted).select(span).select(
        F.regexp_replace(value, r"[^A-Za-z0-9+/_=-]", "").alias("value"), F.lit(True).alias("secret")
    )
    return secrets.union(texts.filter(~hinted).select(F.col("text").alias("value"), F.lit(False).alias("secret")))


def ratio(value: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio per pair of characters."""
    size = len(ALPHABET)
    # By the codes of both characters, all of them ASCII: a place is then a sum and no search.
    by_code = [0.0] * (128 * 128)
    for i, a in enumerate(ALPHABET):
        for j, b in enumerate(ALPHABET):
            by_code[128 * ord(a) + ord(b)] = table[i * size + j]
    numbers = ",".join(f"{x:.6f}" for x in by_code)
    ratios = F.from_json(F.lit(f"[{numbers}]"), "array<double>")
    start = F.struct(F.lit(0).alias("row"), F.lit(0.0).alias("sum"))

    def step(state: Column, character: Column) -> Column:
        code = F.ascii(character)
        # Row 0 is that of no character before.
        total = state["sum"] + F.coalesce(F.get(ratios, state["row"] + code), F.lit(0.0))
        return F.struct((code * 128).alias("row"), total.alias("sum"))

    total = F.aggregate(F.split(value, ""), start, step, lambda state: state["sum"])
    return total / (F.length(value) - 1)


def suspected(text: Column, table: list[float], min_ratio: float) -> Column:
    """Spans, of kind markov, of the runs that the models take for random strings.

    Most texts have none, and so nothing is placed in them."""

    def placed(hits: Column) -> Column:
        def kept(random: Column) -> Column:
            spans = F.zip_with(
                _placed(text, RUN, "markov", hits), random, lambda span, is_random: F.when(is_random, span)
            )
            return F.when(F.exists(random, lambda r: r), F.array_compact(spans)).otherwise(F.array().cast(_SPANS))

        return _let(F.transform(hits, lambda hit: F.coalesce(ratio(hit, table) >= min_ratio, F.lit(False))), kept)

    return _let(F.regexp_extract_all(text, F.lit(RUN), F.lit(0)), placed)


def untouched(runs: Column, spans: Column) -> Column:
    """The runs, in order and apart from each other, that no span overlaps.

    A run is touched if more spans begin before its end than have ended at its start. Both are read off one
    sorted list of all ends, so that it takes n log n of the runs and spans together."""
    # At one place: ends of spans, starts of runs, ends of runs, starts of spans.
    span_end, run_start, run_end, span_start = range(4)

    def event(place: Column, kind: int) -> Column:
        return F.struct(place.alias("place"), F.lit(kind).alias("kind"))

    events = F.array_sort(
        F.concat(
            F.transform(spans, lambda s: event(s["end"], span_end)),
            F.transform(spans, lambda s: event(s["start"], span_start)),
            F.transform(runs, lambda r: event(r["start"], run_start)),
            F.transform(runs, lambda r: event(r["end"], run_end)),
        )
    )

    def chosen(ordered: Column) -> Column:
        def counts(kind: int, at: int) -> Column:
            """How many events of a kind come before each event of another."""
            sums = running_sums(F.transform(ordered, lambda e: (e["kind"] == kind).cast("int")))
            return F.array_compact(F.zip_with(ordered, sums, lambda e, n: F.when(e["kind"] == at, n)))

        numbered = F.zip_with(runs, counts(span_end, run_start), lambda r, n: F.struct(r.alias("run"), n.alias("ended")))
        flagged = F.zip_with(numbered, counts(span_start, run_end), lambda x, n: F.when(n <= x["ended"], x["run"]))
        return F.array_compact(flagged)

    return F.when((F.size(runs) > 0) & (F.size(spans) > 0), _let(events, chosen)).otherwise(runs)


def find_secrets(
    docs: DataFrame,
    table: list[float],
    id_col: str = "doc_id",
    text_col: str = "text",
    min_ratio: float = MIN_RATIO,
) -> DataFrame:
    """id and spans (kind, start, end, value) of every row, by start and then in the order of KINDS.

    Base spans come from the patterns. A run of at least MIN_RUN characters that no base span touches is
    added, as kind markov, if the model of random strings explains it better than the model of
    identifiers by min_ratio for each pair of characters; no other gate comes before the models. A null or empty text has no spans, null
    ids stay null, repeated rows have the same spans, an empty table gives an empty result; other columns are
    never looked at. A text is one piece of work, which grows as n log n with its length and hits.

    One narrow stage of column expressions, without a shuffle; the model is a literal of fixed size.
    """
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    # Patterns first: most texts have nothing that they could find.
    empty = F.array().cast(_SPANS)
    rows = rows.withColumn("base", F.when(text.rlike(HINT), base_spans(text)).otherwise(empty))
    rows = rows.withColumn("random", suspected(text, table, min_ratio))
    rows = rows.withColumn("added", untouched(F.col("random"), F.col("base")))
    return rows.select("id", _ordered("base").alias("base"), _ordered(F.concat("base", "added")).alias("spans"))


def _ordered(spans: Column | str) -> Column:
    """By start, then kind as listed."""
    kinds = F.array(*map(F.lit, KINDS))
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("place"),
            s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"),
        ),
    )
    return F.transform(
        F.array_sort(keyed), lambda s: F.struct(s["kind"], s["start"], s["end"], s["value"])
    )


def written(spans: Column | str) -> Column:
    """kind:start:end, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def trained_table(docs: DataFrame, text_col: str = "text") -> list[float]:
    return bigram_table(labelled_samples(docs, text_col))
