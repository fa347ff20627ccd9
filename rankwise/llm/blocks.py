"""Arrow batches as flat byte arrays, cut into blocks of bounded size.

The numpy operators work on many documents at once: a block is a run of
whole rows whose texts together hold at most ``BLOCK_BYTES`` (or one longer
row), so memory follows the block and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

#: the bytes [\x20\x09-\x0D]
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of each block; null counts as empty."""
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(n, max(stop, row + 1))
        yield row, stop, whole[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each row's end (n + 1 entries).

    A word is a run of bytes outside [\\x20\\x09-\\x0D]; it ends with its row.
    """
    solid = ~IS_SPACE[data]
    begins, ends = solid.copy(), solid.copy()
    if len(data):
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        begins[first] = solid[first]
        ends[last] = solid[last]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def counts_by_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each row of a block."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in at least one of the spans."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:n]) > 0
