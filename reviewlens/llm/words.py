"""Words of Arrow text columns, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; keeps the numpy arrays in megabytes.
SLICE_BYTES = 4 << 20

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def text_column(column: pa.Array) -> pa.Array:
    """Plain string array without nulls; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.string():
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text, at least a row each."""
    at = batch.schema.get_field_index(column)
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and the offset of each text in them (one more than texts)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    return np.frombuffer(data, np.uint8)[low:high], offsets.astype(np.int64) - low


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """Texts with each byte replaced; ``table`` maps ASCII to ASCII and keeps other bytes."""
    data, offsets = raw_bytes(texts)
    return pa.StringArray.from_buffers(
        len(texts),
        pa.py_buffer(offsets.astype(np.int32)),
        pa.py_buffer(data.tobytes().translate(table)),
    )


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of bytes other than 0x20 and 0x09-0x0D, and where each text's words start."""
    if not len(texts):
        return pa.array([], pa.string()), np.zeros(1, np.int64)
    lists = pc.ascii_split_whitespace(texts)
    values = lists.flatten()
    starts = lists.offsets.to_numpy().astype(np.int64)
    starts -= starts[0]
    filled = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    if not filled.all():
        before = np.concatenate([[0], np.cumsum(filled)])
        starts, values = before[starts], values.filter(pa.array(filled))
    return values, starts


def word_ids(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of each word in the batch's own dictionary, and that dictionary."""
    encoded = values.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


def word_hashes(dictionary: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word that is the same in every batch."""
    if not len(dictionary):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(
        dictionary.to_numpy(zero_copy_only=False), hash_key="0123456789abcdef", categorize=False
    )


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def owners(starts: np.ndarray) -> np.ndarray:
    """For each word the row of its text."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def sums_by_row(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; ``starts`` as from ``split_words``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]
