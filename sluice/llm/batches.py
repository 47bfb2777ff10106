"""Texts of Arrow batches as flat byte arrays, for work on whole columns at once."""

import numpy as np
import pyarrow as pa

#: Bytes of text that one step holds as arrays; a longer text is a step of its own.
STEP_BYTES = 4 << 20

_ALL = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, every other byte as it is.
LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)
#: The bytes of [\x20\x09-\x0D].
BLANK = (_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13))


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each row begins and the last ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(offsets, limit=STEP_BYTES):
    """Row ranges (first, end) with about ``limit`` bytes each, one row at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end
        first = end


def release() -> None:
    """Give freed memory back; workers live on between tasks."""
    pa.default_memory_pool().release_unused()


def ranges(starts, lengths) -> np.ndarray:
    """The indexes start, start+1, ... of every range, one range after the other."""
    lengths = np.asarray(lengths, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - before, lengths)


def binary_array(data, starts, ends) -> pa.Array:
    """An Arrow array of the byte ranges, which rise and do not overlap but may have gaps."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    packed = data[ranges(starts, lengths)] if len(starts) and offsets[-1] != ends[-1] - starts[0] else data[starts[0] if len(starts) else 0:]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(packed))])


def word_spans(data, offsets, is_word) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every maximal run of word bytes within a row, and each row's first run.

    The third array has one entry more than there are rows.
    """
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = is_word[data]
    begins = inside[:n].copy()
    begins[1:] &= ~inside[:n - 1]
    at = offsets[:-1][offsets[:-1] < n]
    begins[at] = inside[at]
    ends = inside[:n] & ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] |= inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)
