"""Text annotators as column expressions: document, sentence and token annotations.

The patterns use no look-around and name their whitespace, so any regex engine finds the same
matches. Offsets are inclusive and count characters (code points).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstream.functions.arrays import let, prefix_sums

SPACE = r"[ \t\n\x0B\f\r]"
# The same characters as an SQL string.
BLANKS = r"' \t\n\u000B\u000C\r'"
# A sentence ends with a run of . ! ? that whitespace follows; the rest of the text is the last one.
SENTENCE = rf"(?s).*?[.!?]{SPACE}+|.+"
# Words may hold inner apostrophes and hyphens; any other visible character is a token of its own.
# Possessive: nothing is tried twice, and a word of any number of parts needs no deep recursion.
TOKEN = r"[\p{L}\p{N}_]++(?:['-][\p{L}\p{N}_]++)*+|[^\p{L}\p{N}_ \t\n\x0B\f\r]"
WORD = r"^[\p{L}\p{N}_]"


def pattern(regex: str) -> str:
    """A regular expression as an SQL string without escapes."""
    return f'r"{regex}"'


def annotation(
    kind: str,
    begin: str,
    end: str,
    result: str,
    metadata: str = "map('sentence', '0')",
    embeddings: str = "cast(array() AS array<float>)",
) -> str:
    """One annotation struct, in SQL."""
    return f"""named_struct('annotatorType', '{kind}', 'begin', {begin}, 'end', {end},
      'result', {result}, 'metadata', {metadata}, 'embeddings', {embeddings})"""


def document(text: str) -> Column:
    """The whole text as an array of one annotation; empty for NULL."""
    whole = annotation("document", "0", f"length({text}) - 1", text)
    return F.expr(f"filter(array({whole}), d -> d.result IS NOT NULL)")


def sentences(documents: str) -> Column:
    """Sentence annotations of every document annotation, numbered from 0."""
    one = let(
        "start",
        "doc.begin + get(ends, i) - length(piece)",
        let(
            "kept",
            f"trim(TRAILING {BLANKS} FROM piece)",
            annotation(
                "document",
                "start",
                "start + length(kept) - 1",
                "kept",
                "map('sentence', cast(i AS string))",
            ),
        ),
    )
    # Only a text of nothing but whitespace yields a blank piece.
    spans = f"filter(transform(pieces, (piece, i) -> {one}), s -> s.result <> '')"
    lengths = prefix_sums("transform(pieces, p -> length(p))")
    cut = f"regexp_extract_all(doc.result, {pattern(SENTENCE)}, 0)"
    split = let("pieces", cut, let("ends", lengths, spans))
    return F.expr(f"flatten(transform({documents}, doc -> {split}))")


def tokens(units: str) -> Column:
    """Word and punctuation annotations of every sentence (or document) annotation.

    One regex pass takes each token with the whitespace before it; nothing lies between two such
    pieces, so running lengths are the offsets.
    """
    one = annotation(
        "token",
        "unit.begin + get(ends, i) - length(tok)",
        "unit.begin + get(ends, i) - 1",
        "tok",
        "unit.metadata",
    )
    # A second transform binds the token for less than ``let`` does.
    spans = f"transform(transform(pieces, p -> trim(LEADING {BLANKS} FROM p)), (tok, i) -> {one})"
    lengths = prefix_sums("transform(pieces, p -> length(p))")
    # Without blanks at the end, each of which would be looked through up to the last.
    trimmed = f"trim(TRAILING {BLANKS} FROM unit.result)"
    cut = f"regexp_extract_all({trimmed}, {pattern(f'{SPACE}*+(?:{TOKEN})')}, 0)"
    split = let("pieces", cut, let("ends", lengths, spans))
    return F.expr(f"flatten(transform({units}, unit -> {split}))")


def token_texts(text: Column) -> Column:
    """The tokens of a text without offsets: one regex pass and nothing else."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of tokens, punctuation counted."""
    return F.regexp_count(text, F.lit(TOKEN))
