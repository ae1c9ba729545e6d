"""Words of Arrow arrays of texts, as codes into the distinct ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at a time, or one text where it is longer.
CHUNK_BYTES = 4 << 20


def chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose texts have so many bytes together, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def coded_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words, a code for every word in order, and for each text where its words begin
    and the last one's end. Words are what ASCII white space separates; "" may be among them, where a
    text begins or ends with white space. A null text has no words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), offsets - offsets[0]


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the values of each text, 0 for one without any."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
