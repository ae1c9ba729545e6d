"""Sentences, tokens and offsets against plain Python."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from quillstream.functions import text as X
from quillstream.functions.arrays import map_runs, prefix_sums
from quillstream.functions.stopwords import ENGLISH
from quillstream.operators import annotate
from quillstream.operators.rows import each

BLANK = " \t\n\x0b\x0c\r"


def random_texts(n, seed=7):
    rng = random.Random(seed)
    alphabet = ["a", "B", "é", "ß", "7", "_", "'", "-", ".", "!", "?", ",", " ", " ", "\n", "\t", "😀", "\x0b"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(n)]


TEXTS = [
    "",
    "  ",
    "a b ",
    "  A  b\tc",
    "Hello, world! x",
    ".",
    "Hi.  ",
    ". A",
    "It's a well-known fact... Really?! Yes",
    "no end",
    *random_texts(300),
]


@pytest.fixture(scope="module")
def annotated(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string")
    done = annotate.with_tokens(annotate.with_sentences(annotate.with_document(rows)))
    done = annotate.with_word_count(annotate.with_whitespace_tokens(done))
    return {r.id: r for r in done.withColumn("counted", X.word_count(F.col("text"))).collect()}


def expected_sentences(text):
    marked = regex.sub(r"([.!?]+)([ \t\n\x0b\f\r]+)", "\\1\\2\x00", text)
    out, begin = [], 0
    for piece in marked.split("\x00"):
        kept = piece.rstrip(BLANK)
        if kept:
            out.append((begin, begin + len(kept) - 1, kept))
        begin += len(piece)
    return out


def test_documents(annotated):
    for i, text in enumerate(TEXTS):
        (doc,) = annotated[i].document
        assert (doc.begin, doc.end, doc.result) == (0, len(text) - 1, text)
        assert doc.annotatorType == "document"


def test_null_text_has_no_annotations(spark):
    rows = spark.createDataFrame([(None,)], "text string")
    done = annotate.with_tokens(annotate.with_sentences(annotate.with_document(rows))).first()
    assert (done.document, done.sentence, done.token) == ([], [], [])


def test_sentences(annotated):
    for i, text in enumerate(TEXTS):
        got = [(s.begin, s.end, s.result) for s in annotated[i].sentence]
        assert got == expected_sentences(text), repr(text)
        assert [s.metadata["sentence"] for s in annotated[i].sentence] == [
            str(n) for n in range(len(got))
        ]


def test_tokens(annotated):
    for i, text in enumerate(TEXTS):
        expected = [(m.start(), m.end() - 1, m.group()) for m in regex.finditer(X.TOKEN, text)]
        got = [(t.begin, t.end, t.result) for t in annotated[i].token]
        assert got == expected, repr(text)
        assert annotated[i].wordCount == annotated[i].counted == len(expected)
        spans = [(s.begin, s.end) for s in annotated[i].sentence]
        for t in annotated[i].token:
            begin, end = spans[int(t.metadata["sentence"])]
            assert begin <= t.begin and t.end <= end


def test_tokens_of_the_document(spark):
    rows = annotate.with_document(spark.createDataFrame([("A b. C",)], "text string"))
    token = annotate.with_tokens(rows, units="document").first().token
    assert [(t.begin, t.result) for t in token] == [(0, "A"), (2, "b"), (3, "."), (5, "C")]
    assert {t.metadata["sentence"] for t in token} == {"0"}


@pytest.mark.parametrize(
    "text, tokens, nlp",
    [
        ("", [""], 0),
        ("  ", [], 0),
        ("a b ", ["a", "b"], 2),
        ("  A  b\tc", ["", "", "a", "", "b", "c"], 3),
        ("Hello, world! x", ["hello,", "world!", "x"], 5),
        (".", ["."], 1),
    ],
)
def test_edge_texts(annotated, text, tokens, nlp):
    row = annotated[TEXTS.index(text)]
    assert row.tokens == tokens and row.wordCount == nlp


def test_stop_words(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert StopWordsRemover.loadDefaultStopWords("english") == ENGLISH
    rows = spark.createDataFrame([("The cat AND the hat",)], "text string")
    kept = annotate.without_stop_words(annotate.with_whitespace_tokens(rows)).first()
    assert kept.filtered_token == ["cat", "hat"]


def test_long_text_without_a_boundary(spark):
    """Offsets of one very long sentence: prefix sums stay n log n."""
    text = "word " * 60_000
    rows = annotate.with_document(spark.createDataFrame([(text,)], "text string"))
    token = annotate.with_tokens(annotate.with_sentences(rows)).first().token
    assert len(token) == 60_000
    assert [t.begin for t in token[::9999]] == [5 * i for i in range(0, 60_000, 9999)]


def test_prefix_sums_and_runs(spark):
    rng = random.Random(3)
    rows = [([rng.randint(0, 4) for _ in range(rng.randint(0, 40))],) for _ in range(60)]
    df = spark.createDataFrame(rows, "a array<int>").select(
        "a",
        F.expr(prefix_sums("a")).alias("sums"),
        F.expr(map_runs("sort_array(a)", "run")).alias("runs"),
    )
    for r in df.collect():
        assert r.sums == [sum(r.a[: i + 1]) for i in range(len(r.a))]
        assert r.runs == [[v] * r.a.count(v) for v in sorted(set(r.a))]


def test_each_keeps_no_row_for_empty_arrays(spark):
    rows = spark.createDataFrame([(1, ["x", None]), (2, []), (3, None)], "id int, a array<string>")
    assert [tuple(r) for r in each(rows, "a", "v", "id").collect()] == [(1, 0, "x"), (1, 1, None)]


def test_explode_does_not_repeat_the_annotation(spark):
    rows = spark.createDataFrame([(1, "A b. C")], "id bigint, text string")
    sentence = annotate.with_sentences(annotate.with_document(rows))
    flat = annotate.annotation_rows(sentence, "sentence", "id")
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_hostile_texts_take_no_deep_recursion_and_no_quadratic_time(spark):
    """A chain of 200,000 linked parts, a million dots, a million blanks at the end; not constant, so
    that tasks do the work."""
    rows = spark.range(3).selectExpr(
        "id",
        "CASE id WHEN 0 THEN concat(repeat('a-', 200000), 'a') WHEN 1 THEN concat(repeat('.', 1000000), 'x') "
        "ELSE concat('word', repeat(' ', 1000000)) END AS text",
    )
    counted = rows.select(X.word_count(F.col("text")).alias("n")).collect()
    assert [r.n for r in counted] == [1, 1_000_001, 1]
    cut = rows.select(F.size(F.regexp_extract_all("text", F.lit(X.SENTENCE), F.lit(0))).alias("n")).collect()
    assert [r.n for r in cut] == [1, 1, 1]
