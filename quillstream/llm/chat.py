"""Chat formatting by incremental rendering of a black-box template."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.session import ship_package

Turn = tuple[str, str]
# render(turns, opened): all turns, then, if a role is given, the opening of a turn of that role.
Render = Callable[[list[Turn], str | None], str]

# Control strings are made of these; inside texts and roles each becomes a backslash and a letter.
ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c", "\n": "\\n"}
ORIGINALS = {after[1]: before for before, after in ESCAPES.items()}
OPENING, CLOSING = "### {role}: ", "</turn>\n"
# Characters of a turn whose marked form is kept.
REMEMBERED = 1024


def escape(text: str, characters: str = "\\#<") -> str:
    return re.sub(f"[{re.escape(characters)}]", lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: ORIGINALS[m[1]], text)


@functools.lru_cache(maxsize=16_384)
def _marked_short(role: str, text: str) -> str:
    return _marked(role, text)


def _marked(role: str, text: str) -> str:
    return f"{_opening(role)}{escape(text)}{CLOSING}"


def _opening(role: str) -> str:
    return OPENING.format(role=escape(role, "\\#<:\n"))


def marked_turns(turns: list[Turn], opened: str | None = None) -> str:
    """The template of the registered query: `### role: text</turn>` and a line feed per turn. No
    text or role can hold a control string, since neither `#` nor `<` is left in it. As every prefix is
    rendered again, the latest turns of up to 1,024 characters are remembered (16 MB of ASCII)."""
    out = [(_marked_short if len(role) + len(text) <= REMEMBERED else _marked)(role, text) for role, text in turns]
    if opened is not None:
        out.append(_opening(opened))
    return "".join(out)


def read_turns(formatted: str) -> list[Turn]:
    """The turns that marked_turns was given."""
    turns = []
    for piece in formatted.split(CLOSING)[:-1]:
        role, text = piece.removeprefix("### ").split(": ", 1)
        turns.append((unescape(role), unescape(text)))
    return turns


@dataclass(frozen=True)
class Span:
    """Where a turn is in the output: start and end of all of it, and of the text in it."""

    start: int
    text_start: int
    text_end: int
    end: int


@dataclass(frozen=True)
class Rendered:
    """text: the whole conversation. spans: by turn, None if the template rewrites history, whose
    first rewritten turn is then rewritten_at."""

    text: str
    spans: list[Span] | None
    rewritten_at: int | None = None


def _piece(render: Render, seen: list[Turn], before: str, turn: Turn) -> tuple[str, int, int] | None:
    """What a turn adds behind the prefix before it, and where its text is in that; None if the
    prefix comes out otherwise once the turn is there, or the turn is not opening, text, closing."""
    role, text = turn
    after = render([*seen, turn], None)
    if not after.startswith(before):
        return None
    opened = render(seen, role)
    empty = render([*seen, (role, "")], None)
    if not (opened.startswith(before) and after.startswith(opened) and empty.startswith(opened)):
        return None
    closing = empty[len(opened) :]
    if len(after) < len(empty) or not after.endswith(closing):
        return None
    return after[len(before) :], len(opened) - len(before), len(after) - len(before) - len(closing)


def render_incrementally(turns: list[Turn], render: Render = marked_turns, view: int | None = None) -> Rendered:
    """Render successive prefixes and compare each output with the one before.

    A template that only appends gives each turn a span. If a prefix comes out otherwise once a turn
    follows, the template rewrites history: the result is then the rendering of all turns at once,
    without spans. Only outputs are compared; the template is never looked into.

    Every prefix is whole, so what the template does with any number of earlier turns is seen. That costs
    the square of the turns. Who knows that the template never looks further back than `view` turns may say
    so: each turn is then rendered behind that many, whatever the length of the conversation, and a
    rewriting beyond them is only seen if it is still there in the rendering of all turns.
    """
    if view is not None and view < 1:
        raise ValueError("view must be positive")
    head = before = render([], None)
    pieces, spans = [head], []
    length = len(head)
    for number, turn in enumerate(turns):
        seen = turns[:number] if view is None else turns[max(0, number - view) : number]
        if view is not None and number > view:
            before = head + "".join(pieces[-view:])
            if render(seen, None) != before:
                # The template does look further back.
                return render_incrementally(turns, render)
        found = _piece(render, seen, before, turn)
        if found is None and view is not None and number > view:
            # What it does in the narrowed view says nothing about full prefixes.
            return render_incrementally(turns, render)
        if found is None:
            return Rendered(render(list(turns), None), None, number)
        piece, start, end = found
        spans.append(Span(length, length + start, length + end, length + len(piece)))
        pieces.append(piece)
        length += len(piece)
        before += piece
    text = "".join(pieces)
    if view is not None and len(turns) > view and text != render(list(turns), None):
        return render_incrementally(turns, render)
    return Rendered(text, spans)


def _hex(parts: list[str]) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part.encode("utf-8", "surrogatepass"))
    return digest.hexdigest()


SCHEMA = (
    "conv_id {kind}, n_turns long, formatted string, append_only boolean, "
    "loss_spans array<struct<start:long,end:long>>, turn_starts array<long>"
)


def _conversations(
    batches: Iterator[pa.RecordBatch], trained: str, render: Render, view: int | None
) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn; one row for each conversation."""
    key, turns, started = None, [], False

    def done() -> dict:
        result = render_incrementally(turns, render, view)
        spans = result.spans
        loss = [s for s, (role, _) in zip(spans or [], turns, strict=False) if role == trained]
        return {
            "conv_id": key,
            "n_turns": len(turns),
            "formatted": result.text,
            "append_only": spans is not None,
            "loss_spans": None if spans is None else [{"start": s.text_start, "end": s.text_end} for s in loss],
            "turn_starts": None if spans is None else [s.start for s in spans],
        }

    out: list[dict] = []
    schema = None
    for batch in batches:
        schema = pa.schema(
            [
                ("conv_id", batch.schema.field("conv_id").type),
                ("n_turns", pa.int64()),
                ("formatted", pa.string()),
                ("append_only", pa.bool_()),
                ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ("turn_starts", pa.list_(pa.int64())),
            ]
        )
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
        for conversation, role, text in zip(*columns, strict=True):
            if not started or conversation != key:
                if started:
                    out.append(done())
                key, turns, started = conversation, [], True
            turns.append((role, text))
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
    if started:
        out.append(done())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def format_chats(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained: str = "assistant",
    render: Render = marked_turns,
    view: int | None = None,
) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, append_only, loss_spans (of the texts of the
    trained role, as code points of formatted, end exclusive) and turn_starts.

    Turns are ordered by turn, then role and text, nulls first; equal rows are turns each. A null
    role or text is empty, turns with a null id are one conversation, and a template that rewrites
    history gives null spans. An empty table gives an empty result; other columns are never looked at.

    One shuffle by conversation; tasks read conversations one after another and hold one at a time. A
    conversation is rendered as a whole, so a very long one is one task's work, in the square of its turns
    unless `view` says how far back the template looks (see render_incrementally).
    """
    ship_package(conversations.sparkSession)
    rows = conversations.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    kind = dict(rows.dtypes)["conv_id"]
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(lambda batches: _conversations(batches, trained, render, view), SCHEMA.format(kind=kind))
    )


def chat_digest(formatted: DataFrame) -> DataFrame:
    """What is read back from formatted chats: turns from the text, loss from its spans."""
    ship_package(formatted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns_hex, loss_hex, loss_chars, counts = [], [], [], []
            texts, spans = batch.column("formatted"), batch.column("loss_spans")
            for k in range(batch.num_rows):
                text = texts[k].as_py()
                turns = read_turns(text)
                loss = [unescape(text[s["start"] : s["end"]]) for s in spans[k].as_py() or []]
                counts.append(len(turns))
                turns_hex.append(_hex([p for role, said in turns for p in (role, "\n", said, "\n")]))
                loss_hex.append(_hex(loss))
                loss_chars.append(sum(map(len, loss)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), pa.array(counts, pa.int64()), pa.array(turns_hex, pa.string()),
                    pa.array(loss_chars, pa.int64()), pa.array(loss_hex, pa.string()),
                    batch.column("formatted_chars"),
                ],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    kind = dict(formatted.dtypes)["conv_id"]
    return formatted.withColumn("formatted_chars", F.length("formatted").cast("long")).select(
        "conv_id", "formatted", "loss_spans", "formatted_chars"
    ).mapInArrow(
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
