"""Token counts by byte-pair merging with a heap and a linked list."""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.words import chunks, coded_words, row_sums
from quillstream.session import ship_package

# Counts of word parts that a Python worker remembers; beyond it begins anew.
REMEMBERED = 1_000_000
LIMIT = 2048


class MergeCounter:
    """Counts the tokens of texts for a byte-level BPE file that marks word ends and drops white space.

    Reads the vocabulary, the merges, the pattern that splits words and the special tokens from the
    file. Nothing is encoded: the count of a part is its symbols at first less the merges made.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        suffix = spec["model"]["end_of_word_suffix"] or ""
        self.width = len(vocabulary)
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            key = vocabulary[left] * self.width + vocabulary[right]
            self.merges[key] = (rank, vocabulary[left + right])
        letters = _byte_letters()
        self.inner = [vocabulary[c] for c in letters]
        self.last = [vocabulary[c + suffix] for c in letters]
        splitter = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.parts = regex.compile(splitter.replace(r"\s", r"\p{White_Space}")).findall
        special = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(special)) if special else None
        self.known: dict[str, int] = {"": 0}
        self.path, self.library = path, None
        self.byte_of = {letter: byte for byte, letter in enumerate(letters)}

    def _split(self, word: str) -> list[str]:
        """The parts of a word. Beyond the alphabets that Unicode no longer adds to, what is a letter
        depends on its version: the library, which may have another than this Python, splits these."""
        if max(word) >= "\u0500":
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.path)
            word = self.library.normalizer.normalize_str(word)
            pieces = self.library.pre_tokenizer.pre_tokenize_str(word)
            return [bytes(self.byte_of[c] for c in piece).decode("utf-8", "surrogatepass") for piece, _ in pieces]
        # Each character for itself: a sigma at the end of a word stays an ordinary one.
        return self.parts(unicodedata.normalize("NFC", word).replace("Σ", "σ").lower())

    def word(self, word: str) -> int:
        """Tokens of a text without ASCII white space."""
        count = self.known.get(word)
        if count is not None:
            return count
        if word.isascii() and word.isalpha() and word.islower():
            return self._remember(word)
        if self.special and self.special.search(word):
            between = self.special.split(word)
            return len(between) - 1 + sum(self.word(w) for w in between)
        known = self.known.get
        total = 0
        for part in self._split(word):
            count = known(part)
            total += self._remember(part) if count is None else count
        return total

    def _remember(self, part: str) -> int:
        if len(self.known) >= REMEMBERED:
            self.known = {"": 0}
        count = self.known[part] = self.part(part)
        return count

    def part(self, part: str) -> int:
        """Symbols of one part that are left when no adjacent pair can be merged any more."""
        data = part.encode("utf-8", "surrogatepass")
        inner, width, pair = self.inner, self.width, self.merges.get
        symbols = [inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        size = count = len(symbols)
        heap = []
        left = symbols[0]
        for at in range(1, size):
            right = symbols[at]
            merge = pair(left * width + right)
            if merge is not None:
                heap.append((merge[0], at - 1, merge[1]))
            left = right
        if not heap:
            return count
        heapify(heap)
        following = list(range(1, size + 1))
        previous = list(range(-1, size - 1))
        while heap:
            rank, at, merged = heappop(heap)
            left = symbols[at]
            after = following[at]
            # The pair may have gone since: a dead symbol is -1 and pairs with nothing.
            if left < 0 or after >= size:
                continue
            merge = pair(left * width + symbols[after])
            if merge is None or merge[0] != rank:
                continue
            count -= 1
            symbols[at], symbols[after] = merged, -1
            beyond = following[at] = following[after]
            if beyond < size:
                previous[beyond] = at
                merge = pair(merged * width + symbols[beyond])
                if merge is not None:
                    heappush(heap, (merge[0], at, merge[1]))
            before = previous[at]
            if before >= 0:
                merge = pair(symbols[before] * width + merged)
                if merge is not None:
                    heappush(heap, (merge[0], before, merge[1]))
        return count

    def text(self, text: str) -> int:
        return sum(self.word(w.decode("utf-8", "surrogatepass")) for w in text.encode("utf-8", "surrogatepass").split())


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: its own where that
    is printable, else the next unused one from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """Bytes and tokens of every whole text.

    tokenizer: path of the vocabulary file, the same on every executor. Returns one row per input row:
    id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit). A null or empty text has 0 of both;
    a null id stays null, repeated rows stay, an empty table gives an empty result. Other columns are
    never looked at. Special tokens in a text count one each, as the file's library has it by default.

    Runs inside the tasks of the scan, without a shuffle. The words of a few megabytes of text are
    told apart first; each distinct one is counted once, from parts that the worker has seen before
    where it can.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for chunk in chunks(batches):
            words, codes, offsets = coded_words(chunk.column("text"))
            counts = np.fromiter(map(counter.word, words), np.int64, len(words))
            tokens = row_sums(counts[codes] if len(codes) else counts[:0], offsets)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("id"), chunk.column("n_bytes"), pa.array(tokens)], ["id", "n_bytes", "n_tokens"]
            )

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(
        F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    schema = texts.select("id", "n_bytes", F.lit(0).cast("long").alias("n_tokens")).schema
    return texts.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
