"""Runs of bytes in Arrow arrays of texts, as places in one array of bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """For each byte, whether it is in one of the ranges, both ends included."""
    table = np.zeros(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


def mapped(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """What the table has for each byte; for tables of bytes this is faster than to index by the data."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), dtype=table.dtype)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and the last one ends. Without nulls."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    ends = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    ends = ends.astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of true begin and end (exclusive); none goes on from one text to the next."""
    size = len(inside)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(size, dtype=bool)
    first[0] = True
    first[1:] = ~inside[:-1]
    first[offsets[offsets < size]] = True
    first &= inside
    last = np.zeros(size, dtype=bool)
    last[-1] = True
    last[:-1] = ~inside[1:]
    last[offsets[offsets > 0] - 1] = True
    last &= inside
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text that each place is in."""
    return np.searchsorted(offsets, starts, side="right") - 1


def coded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct byte strings among the runs, and the code of every run."""
    # Runs don't overlap: one may begin where another ends, but no two begin or end at the same place.
    taken = np.zeros(len(data) + 1, dtype=np.int8)
    taken[starts] += 1
    taken[ends] -= 1
    return coded_lengths(data[np.cumsum(taken[:-1], dtype=np.int8).view(bool)], ends - starts)


def coded_lengths(data: np.ndarray, lengths: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The same for byte strings that fill the data, given by their lengths."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    array = pa.Array.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    ).dictionary_encode()
    return array.dictionary.cast(pa.binary()), array.indices.to_numpy()
