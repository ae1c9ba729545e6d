"""Vector best-fit packing of tokenized documents into sequences."""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.shared import settle
from quillstream.llm.spans import LOWER, byte_table, coded_lengths, mapped, text_bytes
from quillstream.llm.words import chunks
from quillstream.session import ship_package

SEQUENCE_TOKENS = 4096
END_ID = 1
# Full sequences' worth of tokens that are packed together, on average: each group leaves a sequence or so not filled.
GROUP_SEQUENCES = 512
# Bytes of ids, about, in a batch that leaves the tokenizer.
BATCH_BYTES = 32 << 20
# Word parts of which a Python worker remembers the ids: the latest ones, from this many to twice as many.
REMEMBERED = 250_000

PLAIN = regex.compile(r"\p{L}+|[^\p{White_Space}\p{L}\p{N}'<|]+")
# The same for lower-cased ASCII.
PLAIN_ASCII = re.compile(r"[a-z]+|[^\x20\x09-\x0Da-z0-9'<|]+")

# Kinds of bytes: white space; letters and signs, whose runs may be encoded apart; all others.
SPACE, LETTER, SIGN, OTHER = range(4)
KIND = np.full(256, SIGN, dtype=np.uint8)
KIND[byte_table((9, 13), (32, 32))] = SPACE
KIND[byte_table((65, 90), (97, 122))] = LETTER
KIND[byte_table((48, 57), (128, 255))] = OTHER
KIND[list(b"'<|")] = OTHER


def coded_parts(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct parts of the texts, whether each is a whole word that has other bytes than plain ones,
    a code for every part in order, and for each text where its parts begin and the last one's end.

    A word of plain bytes falls into runs of letters, in lower case, and of signs; another one stays as it is.
    """
    data, offsets = text_bytes(texts)
    kind = mapped(data, KIND).copy()
    # Letters of Latin-1 beyond ASCII take two bytes, all after 0xC3 but two signs.
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    # Segments of one kind; none goes on from one text to the next.
    text = np.zeros(len(data) + 1, dtype=bool)
    text[offsets] = True
    edge = text[:-1].copy()
    edge[1:] |= kind[1:] != kind[:-1]
    begins = np.flatnonzero(edge)
    ends = np.append(begins[1:], len(data))
    solid = kind[begins] != SPACE
    begins, ends, after = begins[solid], ends[solid], np.append(False, solid[:-1])[solid]
    # A word begins behind white space and with a text; one with other bytes is one part.
    first = ~after | text[begins]
    word = np.cumsum(first) - 1
    whole = np.bincount(word[kind[begins] == OTHER], minlength=word[-1] + 1 if len(word) else 0) > 0
    low, inside = mapped(data, LOWER).copy(), kind != SPACE
    heads = np.flatnonzero(first)
    stops = ends[np.append(heads[1:], len(first)) - 1] if len(heads) else ends
    for a, b in zip(begins[heads[whole]].tolist(), stops[whole].tolist(), strict=True):
        low[a:b] = data[a:b]
    mixed = whole[word]
    ends = np.where(mixed, stops[word], ends) if len(word) else ends
    kept = first | ~mixed
    begins, ends, mixed = begins[kept], ends[kept], mixed[kept]
    distinct, codes = coded_lengths(low[inside], ends - begins)
    of_code = np.zeros(len(distinct), dtype=bool)
    of_code[codes[mixed]] = True
    return distinct.to_pylist(), of_code, codes, np.searchsorted(begins, offsets)


class WordIds:
    """Ids of words and parts of words, as little-endian bytes, from the library.

    A vocabulary that drops white space gives a text the ids of its words one after another, so each
    distinct word is encoded once. A word of plain runs of letters or signs falls into these runs. Ids take 16
    bits where the vocabulary allows it.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kind = id_kind(self.library.get_vocab_size(with_added_tokens=True))
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        # Which ids end a run; none where the vocabulary doesn't mark it.
        self.last = np.zeros(self.library.get_vocab_size(with_added_tokens=True), dtype=bool)
        if suffix := model.get("end_of_word_suffix"):
            self.last[[k for token, k in model["vocab"].items() if token.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def parts(self, parts: list[bytes], mixed: np.ndarray) -> list[bytes]:
        if len(self.known) >= REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found = list(map(known.get, parts))
        missing = np.array([k for k, ids in enumerate(found) if ids is None], dtype=np.int64)
        plain = missing[~mixed[missing]].tolist()
        earlier = [older.get(parts[k]) for k in plain]
        known.update((parts[k], ids) for k, ids in zip(plain, earlier, strict=True) if ids is not None)
        self._encode([parts[k] for k, ids in zip(plain, earlier, strict=True) if ids is None], 512, self._joined)
        for k in plain:
            found[k] = known[parts[k]]
        # Words of more than one run, or in doubt: by their runs.
        runs_of: dict[int, list[bytes]] = {}
        wanted: dict[bytes, None] = {}
        for k in missing[mixed[missing]].tolist():
            text = self._runs(parts[k].decode("utf-8", "surrogatepass"))
            own = [x.encode("utf-8", "surrogatepass") for x in ([text] if type(text) is str else text)]
            runs_of[k] = own
            for run in own:
                if run not in known:
                    if run in older:
                        known[run] = older[run]
                    else:
                        wanted[run] = None
        self._encode([*wanted], 4096, self._each)
        for k, own in runs_of.items():
            found[k] = known[own[0]] if len(own) == 1 else b"".join([known[run] for run in own])
        return found

    def _encode(self, new: list[bytes], size: int, encode: Callable[[list[bytes]], list[bytes]]) -> None:
        for start in range(0, len(new), size):
            some = new[start : start + size]
            self.known.update(zip(some, encode(some), strict=True))

    def _each(self, some: list[bytes]) -> list[bytes]:
        texts = [x.decode("utf-8", "surrogatepass") for x in some]
        encoded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in encoded]

    def _joined(self, some: list[bytes]) -> list[bytes]:
        """Plain runs as one text with blanks between, which is half the work: the ids that end a run tell them apart."""
        text = b" ".join(some).decode("utf-8", "surrogatepass")
        ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.kind)
        stops = np.flatnonzero(self.last[ids]) + 1
        if len(stops) != len(some) or stops[-1] != len(ids):
            return self._each(some)
        data, stops = ids.tobytes(), (stops * ids.itemsize).tolist()
        return [data[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    @staticmethod
    def _runs(word: str) -> str | list[str]:
        """What the library may encode apart: the runs, or the whole word if there is one or in doubt.
        Composed letters only, none that is lowered to a letter and a mark, and none of a block that
        Unicode still adds to."""
        plain = PLAIN
        if word.isascii():
            word, plain = word.lower(), PLAIN_ASCII
        elif "\u0130" in word or max(word) >= "\u0500" or not unicodedata.is_normalized("NFC", word):
            return word
        if word.isalpha():
            return word
        runs = plain.findall(word)
        return runs if len(runs) > 1 and sum(map(len, runs)) == len(word) else word


def id_kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


@functools.lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, size: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = _word_ids(path)
    width = np.dtype(encoder.kind).itemsize
    for chunk in chunks(batches):
        words, mixed, codes, offsets = coded_parts(chunk.column("text"))
        parts = encoder.parts(words, mixed)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // width
        flat = np.frombuffer(b"".join(parts), dtype=encoder.kind)
        begins = np.cumsum(lengths) - lengths

        def batch(rows: list, piece: list, start: list, cuts: list, chunk: pa.RecordBatch = chunk) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    chunk.column("id").take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array([len(c) // width for c in cuts], pa.int64()),
                    pa.array(cuts, pa.binary()),
                ],
                ["id", "piece", "start", "length", "ids"],
            )

        # All ids of the chunk in a row, end_id behind those of each text.
        counts = lengths[codes]
        done = np.cumsum(counts)
        stops = np.concatenate([[0], done])[offsets[1:]] + np.arange(1, chunk.num_rows + 1)
        every = np.empty(int(counts.sum()) + chunk.num_rows, dtype=encoder.kind)
        own = np.ones(len(every), dtype=bool)
        own[stops - 1] = False
        every[own] = flat[np.repeat(begins[codes] - (done - counts), counts) + np.arange(len(every) - chunk.num_rows)]
        every[~own] = end_id

        rows, piece, start, cuts = [], [], [], []
        held = 0
        for row, (first, stop) in enumerate(zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)):
            for number, at in enumerate(range(0, stop - first, size)):
                cut = every[first + at : min(first + at + size, stop)]
                rows.append(row)
                piece.append(number)
                start.append(at)
                cuts.append(cut.tobytes())
                held += cut.nbytes
                if held >= BATCH_BYTES:
                    yield batch(rows, piece, start, cuts)
                    rows, piece, start, cuts = [], [], [], []
                    held = 0
        pa.default_memory_pool().release_unused()
        yield batch(rows, piece, start, cuts)


def tokenized_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence_tokens: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
) -> DataFrame:
    """id, piece, start, length, ids: documents as ids with end_id behind, those longer than a sequence
    cut into pieces of sequence_tokens. The ids of a piece are little-endian numbers in a row, as many bytes each
    as its binary has per token (2 where the vocabulary allows it, else 4)."""
    ship_package(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    long = F.lit(0).cast("long")
    schema = texts.select(
        "id", F.lit(0).alias("piece"), long.alias("start"), long.alias("length"), F.lit(b"").alias("ids")
    ).schema
    return texts.mapInArrow(lambda batches: _pieces(batches, tokenizer, sequence_tokens, end_id), schema)


def best_fit(
    sizes: np.ndarray,
    capacity: tuple[float, float, float],
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    rule: str = "norm",
) -> np.ndarray:
    """A bin for each piece. Bins hold tokens, documents and attention cost (the sum of squared sizes),
    each up to its capacity.

    Pieces come by size, largest first. Of the bins in which a piece fits in every respect, the one
    is taken with the smallest weighted norm of what is then left ("norm"), or with the largest
    weighted dot product of the piece and what is left ("dot"); all as shares of the capacities.
    """
    limits = np.asarray(capacity, dtype=float)
    weight = np.asarray(weights, dtype=float)
    if rule not in ("norm", "dot"):
        raise ValueError("rule must be norm or dot")
    order = np.argsort(-sizes, kind="stable")
    smallest = float(sizes.min()) if len(sizes) else 0.0
    least = np.array([smallest, 1.0, smallest * smallest]) / limits
    chosen = np.empty(len(sizes), dtype=np.int64)
    left = np.empty((3, len(sizes)))
    label = np.empty(len(sizes), dtype=np.int64)
    open_bins = bins = 0
    slack = 1e-9
    for at in order:
        size = float(sizes[at])
        need = np.array([size, 1.0, size * size]) / limits
        room = left[:, :open_bins]
        fits = (room[0] >= need[0] - slack) & (room[1] >= need[1] - slack) & (room[2] >= need[2] - slack)
        candidates = np.flatnonzero(fits)
        if len(candidates):
            rest = room[:, candidates]
            if rule == "norm":
                score = weight @ (rest - need[:, None]) ** 2
                best = candidates[np.argmin(score)]
            else:
                best = candidates[np.argmax((weight * need) @ rest)]
            chosen[at] = label[best]
            left[:, best] -= need
        else:
            best = open_bins
            chosen[at] = label[best] = bins
            left[:, best] = 1.0 - need
            open_bins += 1
            bins += 1
        # A bin that has no room for the smallest piece is closed; the last one takes its place.
        if (left[:, best] < least - slack).any():
            open_bins -= 1
            left[:, best] = left[:, open_bins]
            label[best] = label[open_bins]
    return chosen


def _place(group: pa.Table, capacity: tuple, weights: tuple, rule: str) -> pa.Table:
    group = group.sort_by([("length", "descending"), ("rid", "ascending")])
    sizes = group.column("length").to_numpy()
    bins = best_fit(sizes, capacity, weights, rule)
    order = np.argsort(bins, kind="stable")
    before = np.cumsum(sizes[order]) - sizes[order]
    first = np.r_[True, np.diff(bins[order]) != 0]
    offset = np.empty(len(sizes), dtype=np.int64)
    offset[order] = before - np.repeat(before[first], np.diff(np.r_[np.flatnonzero(first), len(sizes)]))
    sequence = (group.column("bin_group").to_numpy() << 32) + bins
    stored = group.column("ids").to_pylist()
    data = b"".join(stored)
    wide = np.frombuffer(data, dtype=f"<u{len(data) // int(sizes.sum())}").astype("<i4")
    stops = np.cumsum([0, *sizes])
    ids = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(wide, pa.int32()))
    crcs = [zlib.crc32(wide[a:b]) for a, b in zip(stops[:-1], stops[1:], strict=True)]
    return pa.table(
        {
            **{c: group.column(c) for c in ("id", "piece", "start", "length")},
            "ids_crc32": pa.array(crcs, pa.int64()),
            "sequence_id": pa.array(sequence),
            "offset": pa.array(offset),
            "ids": ids,
        }
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence_tokens: int = SEQUENCE_TOKENS,
    max_documents: int | None = None,
    max_cost: float | None = None,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    rule: str = "norm",
    end_id: int = END_ID,
    group_pieces: int | None = None,
    group_sequences: int = GROUP_SEQUENCES,
) -> DataFrame:
    """All documents packed into sequences of at most sequence_tokens tokens, max_documents pieces and
    max_cost attention cost (the sum of squared piece lengths). The defaults of the last two never
    bind: as many pieces as tokens, and the square of the tokens.

    Returns one row per piece: id, piece, start, length, ids_crc32, sequence_id, offset, ids. The ids of a
    piece are those of its sequence from offset on, and ids_crc32 is that of these ids as little-endian 32-bit
    numbers; offsets have no gaps. A null or empty text is a piece of end_id alone; null ids stay null; each of several equal rows
    is packed; an empty table gives an empty result. Only documents longer than a sequence are cut.

    Text never leaves the task that reads it. Pieces are dealt at random into groups of about
    group_sequences full sequences' tokens, or of about group_pieces pieces if that is given, which are packed
    apart, ids included; each leaves a sequence or so not filled, a share that doesn't change with the input
    nor with the length of its documents.
    """
    capacity = (
        float(sequence_tokens),
        float(max_documents or sequence_tokens),
        float(max_cost or sequence_tokens**2),
    )
    # A full piece must fit into a sequence of its own.
    longest = min(sequence_tokens, int(capacity[2] ** 0.5))
    cut = tokenized_pieces(docs, tokenizer, id_col, text_col, longest, end_id)
    cut = settle(cut.select("*", F.monotonically_increasing_id().alias("rid")), "pieces")
    whole = cut.agg(F.count("*").alias("pieces"), F.sum("length").alias("tokens")).first()
    held, most = (whole["pieces"], group_pieces) if group_pieces else (whole["tokens"] or 0, group_sequences * sequence_tokens)
    groups = -(-held // most) or 1
    dealt = cut.withColumn("bin_group", F.pmod(F.xxhash64("rid"), F.lit(groups)))
    long = F.lit(0).cast("long")
    schema = dealt.select(
        "id", "piece", "start", "length", long.alias("ids_crc32"), long.alias("sequence_id"), long.alias("offset"),
        F.lit(None).cast("array<int>").alias("ids"),
    ).schema
    return dealt.groupBy("bin_group").applyInArrow(lambda g: _place(g, capacity, weights, rule), schema)
