"""License scans by a positional index of rare licence words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.spans import LOWER, byte_table, coded, mapped, rows_of, runs, text_bytes
from quillstream.llm.words import chunks
from quillstream.session import ship_package

# Phrases whose places are listed, with their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Opening words of public licence notices, and the phrases that a copy must have.
NOTICES = {
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation",
        ("affero general public license",),
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
        ("apache license version 2 0",),
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice",
        ("source and binary forms", "redistributions of source code"),
    ),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0", ("cc by nc",)),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
        ("gnu general public license",),
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
        ("permission to use copy modify", "with or without fee"),
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
        ("lesser general public license",),
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
        ("permission is hereby granted", "deal in the software without restriction"),
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file",
        ("mozilla public license",),
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software",
        ("unencumbered software released into the public domain",),
    ),
}

# Rarest words of a notice that are looked up in a file.
LOOKED_UP = 8
# Of these so many percent must stand as in the notice, ...
AGREE_PERCENT = 75
# ... moved against each other by as many words at most.
SLACK = 4

WORD = byte_table((48, 57), (65, 90), (97, 122), (128, 255))


def words_of(text: str) -> tuple[str, ...]:
    return tuple(re.findall(r"[a-z0-9]+", text.lower()))


@dataclass(frozen=True)
class Notice:
    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[str, ...], ...]

    @property
    def looked_up(self) -> int:
        return min(LOOKED_UP, len(set(self.words)))

    @property
    def needed(self) -> int:
        return -(-AGREE_PERCENT * self.looked_up // 100)


NOTICE_LIST = tuple(Notice(label, words_of(text), tuple(map(words_of, keys))) for label, (text, keys) in NOTICES.items())
PHRASE_LIST = tuple((words_of(phrase), label) for phrase, label in PHRASES.items())


class Index:
    """Postings of the notices' words, rarest word first."""

    def __init__(self, found: dict[str, int]) -> None:
        """found: in how many documents a word is; the fewer, the higher its inverse document frequency."""
        vocabulary = {w for n in NOTICE_LIST for w in n.words} | {w for p, _ in PHRASE_LIST for w in p}
        self.words = sorted(vocabulary, key=lambda w: (found.get(w, 0), w))
        self.rank = {w: k for k, w in enumerate(self.words)}
        self.code = {w.encode(): k for w, k in self.rank.items()}
        self.postings = []
        for notice in NOTICE_LIST:
            places: dict[int, list[int]] = {}
            for at, word in enumerate(notice.words):
                places.setdefault(self.rank[word], []).append(at)
            self.postings.append({k: np.array(v) for k, v in sorted(places.items())})


class Files:
    """The licence words of a chunk of texts: where each stands, counted over the chunk."""

    def __init__(self, texts: pa.Array, index: Index) -> None:
        data, offsets = text_bytes(texts)
        starts, ends = runs(mapped(data, WORD), offsets)
        self.index, self.count = index, len(texts)
        self.row = rows_of(starts, offsets)
        self.begins = np.searchsorted(self.row, np.arange(self.count + 1))
        distinct, codes = coded(mapped(data, LOWER), starts, ends)
        known = np.array([index.code.get(w, -1) for w in distinct.to_pylist()], dtype=np.int64)
        code = known[codes] if len(codes) else np.zeros(0, np.int64)
        at = np.flatnonzero(code >= 0)
        order = np.argsort(code[at], kind="stable")
        self.at = at[order]
        self.bounds = np.searchsorted(code[at][order], np.arange(len(index.words) + 1))

    def occurrences(self, word: int) -> np.ndarray:
        return self.at[self.bounds[word] : self.bounds[word + 1]]

    def present(self) -> np.ndarray:
        """For each text and licence word, whether it has it."""
        table = np.zeros((self.count, len(self.index.words)), dtype=bool)
        table[self.row[self.at], np.repeat(np.arange(len(self.index.words)), np.diff(self.bounds))] = True
        return table

    def places(self, phrase: tuple[str, ...]) -> np.ndarray:
        """Where the words of a phrase stand one after another: the places that the rarest word gives,
        then those of them that the others give too."""
        starts = None
        for rank, step in sorted((self.index.rank[w], k) for k, w in enumerate(phrase)):
            own = self.occurrences(rank) - step
            starts = own if starts is None else np.intersect1d(starts, own, assume_unique=True)
            if not len(starts):
                return starts
        starts = starts[(starts >= 0) & (starts + len(phrase) <= len(self.row))]
        return starts[self.row[starts] == self.row[starts + len(phrase) - 1]]

    def notices(self) -> dict[int, dict[str, int]]:
        """For the texts with copies of notices, the most looked-up words that stand as in each of them."""
        found: dict[int, dict[str, int]] = {}
        present = self.present()
        for notice, postings in zip(NOTICE_LIST, self.index.postings, strict=True):
            ranks = np.array([*postings])
            here = present[:, ranks]
            able = here.sum(axis=1) >= notice.needed
            keys = [self.places(k) for k in notice.keys]
            for starts in keys:
                able &= np.bincount(self.row[starts], minlength=self.count) > 0
            for row in np.flatnonzero(able):
                agree = self._align(int(row), notice, postings, ranks[here[row]][:LOOKED_UP], keys)
                if agree:
                    found.setdefault(int(row), {})[notice.label] = agree
        return found

    def _align(self, row: int, notice: Notice, postings: dict, looked_up: np.ndarray, keys: list) -> int:
        first, last = self.begins[row], self.begins[row + 1]
        offsets, words = [], []
        for k, rank in enumerate(looked_up):
            own = self.occurrences(rank)
            own = own[np.searchsorted(own, first) : np.searchsorted(own, last)]
            votes = (own[:, None] - postings[rank][None, :]).ravel()
            offsets.append(votes)
            words.append(np.full(len(votes), k))
        offset, word = np.concatenate(offsets), np.concatenate(words)
        order = np.argsort(offset, kind="stable")
        offset, word = offset[order], word[order]
        # Votes of each word up to each place, so that a window's are a difference.
        votes = np.zeros((len(offset) + 1, len(looked_up)), dtype=np.int32)
        votes[np.arange(1, len(offset) + 1), word] = 1
        np.cumsum(votes, axis=0, out=votes)
        begin = np.searchsorted(offset, offset, side="left")
        end = np.searchsorted(offset, offset + SLACK, side="right")
        agree = (votes[end] > votes[begin]).sum(axis=1)
        agree[agree < notice.needed] = 0
        for phrase, starts in zip(notice.keys, keys, strict=True):
            starts = starts[np.searchsorted(starts, first) : np.searchsorted(starts, last)]
            high = offset + len(notice.words) + SLACK - len(phrase)
            agree[np.searchsorted(starts, high, side="right") <= np.searchsorted(starts, offset - SLACK)] = 0
        return int(agree.max(initial=0))


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = Index({})
    total = np.zeros(len(index.words), dtype=np.int64)
    for chunk in chunks(batches):
        total += Files(chunk.column("text"), index).present().sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(index.words), pa.array(total)], ["word", "documents"])


def _scan(batches: Iterator[pa.RecordBatch], index: Index, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        files = Files(chunk.column("text"), index)
        count = np.zeros(files.count, dtype=np.int64)
        first = np.full(files.count, np.iinfo(np.int64).max)
        last = np.full(files.count, -1)
        base: list[set[str]] = [set() for _ in range(files.count)]
        for phrase, label in PHRASE_LIST:
            starts = files.places(phrase)
            rows = files.row[starts]
            own = starts - files.begins[rows]
            np.add.at(count, rows, 1)
            np.minimum.at(first, rows, own)
            np.maximum.at(last, rows, own)
            for row in np.unique(rows):
                base[row].add(label)
        notices = files.notices()
        size = {n.label: n.looked_up for n in NOTICE_LIST}
        labels, scores, copies = [], [], []
        for row, own in enumerate(base):
            told = notices.get(row, {})
            labels.append(",".join(sorted(own | told.keys())))
            scores.append(max([float(bool(own)), *(n / size[k] for k, n in told.items())]))
            copies.append(sorted(told.items()))
        none = count == 0
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("id"),
                pa.array(np.diff(files.begins)),
                pa.array(count),
                pa.array(first, mask=none),
                pa.array(last, mask=none),
                pa.array([",".join(sorted(x)) for x in base], pa.string()),
                pa.array(labels, pa.string()),
                pa.array(scores, pa.float64()),
                pa.array(copies, schema),
            ],
            ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"],
        )


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The licences that files name or copy the notice of.

    Words are runs of digits, letters (A-Z in lower case) and anything beyond ASCII. The words of all notices
    are ranked by their document frequency over all files. For each notice a file's LOOKED_UP rarest of its
    words are looked up; each of their places, less those in the notice, votes for where the notice begins.
    Where AGREE_PERCENT of the words vote within SLACK places, and every key phrase of the notice stands
    within its length from there, SLACK more on both sides, the file has its label. Phrases of PHRASES are found by the same index:
    all their words must stand one after another.

    Returns one row per input row: id, n_words, n_base (places of phrases), first_word and last_word (their
    smallest and largest start, null if none), base_labels, labels (with those of notices; both sorted),
    score (1 if there is a base label, else the largest share of looked-up words that agree, else 0), notices (label
    and number of agreeing words of each copy). A null or empty text has no words; a null id stays null; repeated
    rows stay; an empty table gives an empty result; other columns are never looked at. A text is one
    piece of work, about 20 times its bytes of memory.

    Two scans and no shuffle of texts: the first counts, per task, the files that have each of a few hundred words.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    counts = texts.select("text").mapInArrow(_document_counts, "word string, documents long").groupBy("word")
    index = Index({r["word"]: r["n"] for r in counts.agg(F.sum("documents").alias("n")).collect()})
    long = F.lit(0).cast("long")
    schema = texts.select(
        "id",
        long.alias("n_words"),
        long.alias("n_base"),
        F.lit(None).cast("long").alias("first_word"),
        F.lit(None).cast("long").alias("last_word"),
        F.lit("").alias("base_labels"),
        F.lit("").alias("labels"),
        F.lit(0.0).alias("score"),
        F.lit(None).cast("array<struct<label:string,agree:long>>").alias("notices"),
    ).schema
    copies = pa.list_(pa.struct([("label", pa.string()), ("agree", pa.int64())]))
    return texts.mapInArrow(lambda batches: _scan(batches, index, copies), schema)
