"""License scans, collocations and divergence against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillstream.llm import collocations, divergence, licenses


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def brute_collocations(docs, min_found, top):
    counts, sizes = defaultdict(Counter), Counter()
    for d in docs:
        lang = "und" if d["lang"] is None else d["lang"]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(d["text"])):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = set()
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= min_found}
        gone = {p[i : i + 2] for p, a in found.items() if len(p) == 3 for i in (0, 1) if 100 * a >= 50 * own[p[i : i + 2]]}
        scored = []
        for p, a in found.items():
            if p not in gone:
                score, _, left, right = min(
                    (1000000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p))
                )
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return out


@pytest.fixture
def mixed(spark):
    draw = random.Random(11)
    words = ["Alpha", "beta", "gamma", "δέλτα", "eps-ilon", "x", "naïve", "ZETA"]
    docs = []
    for k in range(80):
        text = "".join(
            draw.choice(words) + draw.choice([" "] * 8 + ["\t ", ". ", "\n", ", ", "!", "\r\n"]) for _ in range(draw.randrange(60))
        )
        docs.append((k, text, draw.choice(["en", "de", None, "und"]), draw.choice(["a", "b", "c", None])))
    docs += [(900, None, "en", "a"), (901, "", "fr", "z"), (None, "Alpha beta", "en", "b"), (None, "Alpha beta", "en", "b")]
    docs.append((902, "long words " * 5000, "nn", "y"))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("fp_bits", [64, 12])
def test_collocations(mixed, monkeypatch, fp_bits):
    # Few bits make most fingerprints collide.
    found = rows(collocations.collocations(mixed, min_found=4, top=30, fp_bits=fp_bits))
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    got = {tuple(r[c] for c in columns) for r in found}
    assert len(got) == len(found)
    assert got == brute_collocations(rows(mixed), 4, 30)


def test_collocations_of_odd_rows(odd, none):
    found = rows(collocations.collocations(odd))
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert {tuple(r[c] for c in columns) for r in found} == brute_collocations(rows(odd), 10, 2000)
    assert collocations.collocations(none).count() == 0


def test_segments_join_up():
    texts = ["One two three. four five " * 3, "", "six", "a b " * 40 + "c"]
    whole = collocations.Grams(64)
    expected = [s.prints(2, s.at(2)).tolist() for s in whole.segments(pa.array(texts), ["en"] * 4)]
    cut = collocations.SEGMENT
    try:
        collocations.SEGMENT = 7
        parts = [s.prints(2, s.at(2)).tolist() for s in collocations.Grams(64).segments(pa.array(texts), ["en"] * 4)]
    finally:
        collocations.SEGMENT = cut
    assert len(parts) > len(expected) == 1
    assert [x for part in parts for x in part] == expected[0]


def brute_divergence(docs, min_documents, listed):
    times, documents, groups = defaultdict(Counter), defaultdict(Counter), set()
    for d in docs:
        lang, source = d["lang"] or "", d["source"] or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(d["text"]))
        groups.add((lang, source))
        documents[lang].update(set(terms))
        times[lang, source].update(terms)
    out = set()
    for lang in {x for x, _ in groups}:
        kept = {t for t, n in documents[lang].items() if n >= min_documents}

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        own = sorted(s for x, s in groups if x == lang)
        whole = shares(sum((times[lang, s] for s in own), Counter()))
        by_source = {s: shares(times[lang, s]) for s in own}
        for s in own:
            p = by_source[s]
            pairs = [(sum((p[t] - q) ** 2 // q for t, q in by_source[o].items()), o) for o in own if o != s]
            terms = [((p[t] - q) ** 2 // q, t) for t, q in whole.items() if times[lang, s][t] and p[t] > q]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, i, v, k) for k, (v, i) in enumerate(found[: listed if part == "term" else None], 1)}
    return out


@pytest.mark.parametrize("first_prefix", [1, 4])
def test_divergence(mixed, odd, none, monkeypatch, first_prefix):
    monkeypatch.setattr(divergence, "BLOCK_ROWS", 8)
    monkeypatch.setattr(divergence, "CELLS", 8)
    columns = ("lang", "source", "part", "item", "value", "rank")
    for docs in (mixed, odd):
        found = rows(divergence.source_divergence(docs, terms_listed=4, first_prefix=first_prefix))
        got = {tuple(r[c] for c in columns) for r in found}
        assert len(got) == len(found)
        assert got == brute_divergence(rows(docs), 3, 4)
    assert divergence.source_divergence(none).count() == 0


def test_kept_terms_of_every_length(spark):
    terms = ["a", "ab", "abc", "abcd", "abcde", "abcdefgh", "abcdefghi", "é" * 9, "z" * 3000]
    docs = [("x", "s", " ".join(terms))] * 3 + [("x", "s", "once" * 5 + " abcdeful")] + [("y", "s", "abcdefgh")] * 2
    found = rows(divergence.kept_terms(spark.createDataFrame(docs, "lang string, source string, text string")))
    assert {(r["lang"], r["term"], r["times"]) for r in found} == {("x", t, 3) for t in terms}


def test_license_notices(spark, odd, none):
    filler = "words of no concern to anyone " * 40
    docs = [(k, f"{filler}\n// {text}\n{filler}", label) for k, (label, (text, _)) in enumerate(licenses.NOTICES.items())]
    # A few other words within a notice.
    changed = licenses.NOTICES["mit"][0].replace("a copy", "one copy").replace("free of charge", "free of any charge")
    docs += [(100, changed.upper(), "mit"), (101, " ".join(reversed(changed.split())), None), (102, "see the GNU text", None)]
    docs.append((103, "the " * 50_000 + licenses.NOTICES["bsd"][0] + " software" * 50_000, "bsd"))
    found = {r["id"]: r for r in rows(licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string, label string")))}
    for doc_id, _, label in docs:
        labels = found[doc_id]["labels"].split(",")
        assert (label in labels) if label else labels == [""]
        assert (found[doc_id]["score"] >= 0.75) == (label is not None)
    assert found[100]["base_labels"] == "" and found[100]["n_base"] == 0 and found[100]["first_word"] is None
    strange = rows(licenses.scan_licenses(odd))
    assert len(strange) == 11 and all(r["labels"] == "" and r["score"] == 0 for r in strange)
    assert licenses.scan_licenses(none).count() == 0


def test_license_phrases(spark):
    texts = ["MIT License; mit-license, MITLicense mit\nlicense", "the apache  license (GNU General Public License)", "mit", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["id"]: r for r in rows(licenses.scan_licenses(docs))}
    assert [found[k]["n_base"] for k in range(4)] == [3, 2, 0, 0]
    assert (found[0]["first_word"], found[0]["last_word"], found[0]["n_words"]) == (0, 5, 7)
    assert found[1]["base_labels"] == "apache,gpl" and found[1]["score"] == 1.0
    across = spark.createDataFrame([(0, "one mit"), (1, "license two")], "doc_id int, text string").coalesce(1)
    assert licenses.scan_licenses(across).agg(F.sum("n_base")).first()[0] == 0
