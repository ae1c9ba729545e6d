"""Keywords against a plain implementation of the formula."""

import math
import random
import statistics
from collections import Counter, defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from quillstream.functions import keywords as module
from quillstream.functions.keywords import ACRONYM, CAPITAL, keywords
from quillstream.functions.stopwords import ENGLISH
from quillstream.functions.text import TOKEN
from quillstream.operators import annotate

STOP = set(ENGLISH)


def plain_keywords(sentences, threshold=0.6, sizes=(2, 3), top=10):
    words = []
    for s, sentence in enumerate(sentences):
        seen = False
        for p, tok in enumerate(sentence):
            if not regex.match(r"[\p{L}\p{N}_]", tok):
                continue
            capital = seen and bool(regex.match(CAPITAL, tok))
            words.append((s, p, tok.lower(), capital, bool(regex.match(ACRONYM, tok))))
            seen = True
    if not words:
        return []
    place = {(s, p): w for s, p, w, _, _ in words}
    tf = Counter(w for _, _, w, _, _ in words)
    caps, acrs, where = Counter(), Counter(), defaultdict(list)
    left, right = defaultdict(list), defaultdict(list)
    for s, p, w, capital, acronym in words:
        caps[w] += capital
        acrs[w] += acronym
        where[w].append(s)
        if (s, p - 1) in place:
            left[w].append(place[s, p - 1])
        if (s, p + 1) in place:
            right[w].append(place[s, p + 1])
    typical = statistics.mean(tf.values()) + statistics.pstdev(tf.values())
    score = {}
    for w, n in tf.items():
        diversity = sum(len(set(side[w])) / len(side[w]) for side in (left, right) if side[w])
        rel = 1 + diversity * n / max(tf.values())
        case = max(caps[w], acrs[w]) / (1 + math.log(n))
        pos = math.log(math.log(3 + statistics.median(where[w])))
        spread = len(set(where[w])) / len(sentences)
        score[w] = rel * pos / (case + n / typical / rel + spread / rel)
    found = defaultdict(list)
    for s, p, *_ in words:
        for n in sizes:
            gram = [place.get((s, p + j)) for j in range(n)]
            if None in gram:
                continue
            if any(e in STOP or not regex.search(r"\p{L}", e) for e in (gram[0], gram[-1])):
                continue
            found[" ".join(gram)].append([score[g] for g in gram])
    ranked = []
    for text, hits in found.items():
        value = math.prod(hits[0]) / (len(hits) * (1 + sum(hits[0])))
        value = math.floor(value * 1e9 + 0.5) / 1e9
        if value <= threshold:
            ranked.append((value, text))
    return sorted(ranked)[:top]


def random_sentences(rng):
    vocabulary = ["data", "Data", "NASA", "the", "of", "x-ray", "7", "café", "model", "a1", ",", "-", "Spark"]
    return [rng.choices(vocabulary, k=rng.randint(1, 9)) + ["."] for _ in range(rng.randint(1, 8))]


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(11)
    docs = [random_sentences(rng) for _ in range(150)]
    # The same words as the tokenizer sees them in the joined text.
    return [[regex.findall(TOKEN, " ".join(s)) for s in doc] for doc in docs]


def extract(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    rows = annotate.with_tokens(annotate.with_sentences(annotate.with_document(rows)))
    return {r.id: r for r in annotate.with_keywords(rows, **options).collect()}


@pytest.mark.parametrize("options", [{}, {"threshold": 0.05}, {"top": 3, "min_n": 1, "max_n": 2}])
def test_against_plain_python(spark, documents, options):
    texts = [" ".join(" ".join(s) for s in doc) for doc in documents]
    rows = extract(spark, texts, **options)
    sizes = range(options.get("min_n", 2), options.get("max_n", 3) + 1)
    some = 0
    for i, doc in enumerate(documents):
        expected = plain_keywords(
            doc, options.get("threshold", 0.6), sizes, options.get("top", 10)
        )
        got = [(float(k.metadata["score"]), k.result) for k in rows[i].keywords]
        assert [t for _, t in got] == [t for _, t in expected]
        assert [s for s, _ in got] == pytest.approx([s for s, _ in expected], abs=2e-9)
        some += len(got)
    assert some > 100


def test_offsets_and_limits(spark):
    text = "Data science is fun. We like data science, data science and big models."
    (row,) = extract(spark, [text]).values()
    assert 0 < len(row.keywords) <= 10
    for k in row.keywords:
        assert text[k.begin : k.end + 1].lower() == k.result
        assert 2 <= len(k.result.split()) <= 3
        sentence = row.sentence[int(k.metadata["sentence"])]
        assert sentence.begin <= k.begin and k.end <= sentence.end
    scores = [float(k.metadata["score"]) for k in row.keywords]
    assert scores == sorted(scores)
    assert "data science" in [k.result for k in row.keywords]


def test_empty_and_wordless(spark):
    rows = extract(spark, ["", "  ", "...", "one"])
    assert [r.keywords for r in rows.values()] == [[], [], [], []]


def test_no_shuffle(spark):
    rows = spark.createDataFrame([(1, "A b. C")], "id bigint, text string")
    rows = annotate.with_tokens(annotate.with_sentences(annotate.with_document(rows)))
    plan = rows.select(keywords("token").alias("k"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_words_are_not_looked_at_by_interpreted_lambdas(spark):
    rows = spark.createDataFrame([(1, "A b. C")], "id bigint, text string")
    rows = annotate.with_tokens(annotate.with_sentences(annotate.with_document(rows)))
    # What runs inside Spark for the keywords, beside the tokens: one pass, and no sort.
    plan = rows.select(keywords("token").alias("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array" not in plan
    assert plan.count("ArrowEvalPython") == 1


def test_missing_tokens_and_slices(spark, monkeypatch):
    texts = ["Big data. Big data.", None, "", "Ein ΣΙΣΥΦΟΣ, İstanbul 7 x-ray's NASA data " * 3, "... ok fine"] * 4
    whole = extract(spark, texts)
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    rows = annotate.with_tokens(annotate.with_sentences(annotate.with_document(rows)))
    none = rows.withColumn("token", F.when(F.col("id") % 2 == 0, F.col("token")))
    got = {r.id: r.keywords for r in annotate.with_keywords(none).collect()}
    assert got == {i: r.keywords if i % 2 == 0 else None for i, r in whole.items()}
    assert len(got[0]) > 0
    # However a batch is cut, each row keeps its own keywords, with places from its first token on.
    said = rows.select(F.expr(module._said("token")).alias("t")).toArrow().column("t").combine_chunks()
    once = module._ranked(said, (2, 3), 0.6, 10, ENGLISH)
    monkeypatch.setattr(module, "FLUSH_TOKENS", 10)
    slices = list(module._slices(said))
    assert len(slices) > 4
    cut = [row for part in slices for row in module._ranked(part, (2, 3), 0.6, 10, ENGLISH).to_pylist()]
    assert cut == once.to_pylist()
