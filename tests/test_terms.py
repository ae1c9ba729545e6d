"""Term statistics against plain Python and MLlib."""

import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import IDF
from pyspark.sql import functions as F

from quillstream.operators import annotate, terms
from quillstream.session import scratch_path

M = 0xFFFFFFFF


def murmur3(data: bytes, seed: int = 42) -> int:
    """MurmurHash3 x86 32 bit (Appleby, public domain), signed."""

    def rotl(x, r):
        return ((x << r) | (x >> (32 - r))) & M

    def mix(k):
        return rotl(k * 0xCC9E2D51 & M, 15) * 0x1B873593 & M

    h, whole = seed, len(data) // 4 * 4
    for i in range(0, whole, 4):
        h = (rotl(h ^ mix(int.from_bytes(data[i : i + 4], "little")), 13) * 5 + 0xE6546B64) & M
    if data[whole:]:
        h ^= mix(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ (h >> shift)) * factor & M
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["the", "The", "spark", "café", "a,", "b.", "zz"]
    return ["", "  "] + [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(80)]


@pytest.fixture(scope="module")
def items(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    return annotate.with_whitespace_tokens(rows).cache()


def counts(texts):
    plain = {i: Counter(t.lower().split(" ")) for i, t in enumerate(texts)}
    plain[1] = Counter()  # nothing but blanks
    return plain


def test_hashed_frequency(items, texts):
    rows = {r.id: r.raw_tf for r in terms.hashed_term_frequency(items).collect()}
    for i, counted in counts(texts).items():
        buckets = Counter()
        for term, n in counted.items():
            buckets[murmur3(term.encode()) % (1 << 18)] += n
        got = dict(zip(rows[i].indices.tolist(), rows[i].values.tolist(), strict=True))
        assert rows[i].size == 1 << 18 and got == buckets


def test_exact_frequency_needs_no_shuffle(items, texts):
    frequency = terms.term_frequency(items.select("id", "tokens"))
    assert "Exchange" not in frequency._jdf.queryExecution().executedPlan().toString()
    got = {(r.id, r.term): r.tf for r in frequency.collect()}
    assert got == {(i, t): n for i, c in counts(texts).items() for t, n in c.items()}


@pytest.mark.parametrize("min_doc_freq", [0, 70])
def test_idf_and_tf_idf(spark, items, texts, min_doc_freq):
    fitted = terms.fit_idf(items, scratch_path(spark, "idf"), min_doc_freq)
    counted = counts(texts)
    df = Counter(t for c in counted.values() for t in c)
    weight = {t: math.log((len(texts) + 1) / (n + 1)) for t, n in df.items() if n >= min_doc_freq}
    table = {r.term: r.idf for r in fitted.read(spark).collect()}
    assert table == pytest.approx(weight) and fitted.n_terms == len(weight)
    assert not min_doc_freq or 0 < len(weight) < len(df)
    got = {(r.id, r.term): r.tf_idf for r in terms.tf_idf(items, fitted).collect()}
    assert got == pytest.approx(
        {(i, t): n * weight.get(t, 0.0) for i, c in counted.items() for t, n in c.items()}
    )


def test_idf_agrees_with_mllib(spark, items):
    """With buckets enough that the few terms do not collide, MLlib gives the same weights."""
    hashed = terms.hashed_term_frequency(items)
    weights = IDF(inputCol="raw_tf", outputCol="w").fit(hashed).idf.toArray()
    fitted = terms.fit_idf(items, scratch_path(spark, "idf"))
    for r in fitted.read(spark).collect():
        assert weights[murmur3(r.term.encode()) % (1 << 18)] == pytest.approx(r.idf)


def test_unseen_term(spark, items):
    fitted = terms.fit_idf(items, scratch_path(spark, "idf"))
    new = spark.createDataFrame([(1, ["never", "never", "the"])], "id bigint, tokens array<string>")
    got = {r.term: r.tf_idf for r in terms.tf_idf(new, fitted).collect()}
    assert got["never"] == pytest.approx(2 * math.log(fitted.n_docs + 1))


def test_joins_of_large_tables_equal_broadcast(spark):
    """A term in a third of all pairs, one that the table doesn't know, null terms, clashing ids."""
    kind = F.col("id") % 3
    pairs = spark.range(3000).select(
        (F.col("id") % 1000).alias("id"),
        F.when(kind == 0, "hot").when(kind == 1, F.concat(F.lit("t"), "id")).alias("term"),
    )
    rows = [("hot", 1000, 1.0, None), ("t1", 1, 2.0, "x"), ("t4", 1, None, "y")]
    table = spark.createDataFrame(rows, "term string, n bigint, w double, v string")
    # By the share of pairs all three are hot, or the first one is.
    small = terms.join_term_table(pairs, table, "id", broadcast=True)
    for n_pairs in (3000, 100 * terms.HOT_TERMS):
        large = terms.join_term_table(pairs, table, "id", broadcast=False, n_pairs=n_pairs)
        assert large.columns == ["id", "term", "w", "v"]
        left, right = (sorted(map(tuple, x.select("id", "term", "w", "v").collect()), key=str) for x in (small, large))
        assert left == right and len(left) == 3000


def test_tf_idf_by_a_shuffle(spark, items, monkeypatch):
    fitted = terms.fit_idf(items, scratch_path(spark, "idf"))
    expected = sorted(map(tuple, terms.tf_idf(items, fitted).collect()))
    monkeypatch.setattr(terms, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, terms.tf_idf(items, fitted).collect())) == expected
    assert fitted.n_pairs == len(expected)


def test_a_batch_does_not_shuffle_a_large_table(spark, monkeypatch):
    """The table went through a shuffle for every batch of a stream."""
    from quillstream.operators import terms
    from quillstream.session import scratch_path

    past = spark.createDataFrame([(k, [f"w{k % 7}", f"own{k}", "the"]) for k in range(60)], "id long, tokens array<string>")
    fitted = terms.fit_idf(past, scratch_path(spark, "idf"))
    now = spark.createDataFrame([(1, ["the", "w3", "w3", "new"]), (2, ["own5", ""])], "id long, tokens array<string>")
    small = {tuple(r) for r in terms.tf_idf(now, fitted).collect()}
    monkeypatch.setattr(terms, "BROADCAST_BYTES", 2000)
    assert fitted.n_bytes > 2000
    found = terms.tf_idf(now, fitted, batch=True)
    assert {tuple(r) for r in found.collect()} == small
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(terms, "BROADCAST_BYTES", 0)
    assert {tuple(r) for r in terms.tf_idf(now, fitted, batch=True).collect()} == small
