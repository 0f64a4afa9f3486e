"""Words of Arrow string columns as numpy arrays, without a loop over documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes of a word: all but ASCII blanks, or ASCII letters, digits and all non-ASCII characters.
UNBLANK = np.ones(256, dtype=bool)
UNBLANK[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple]:
    """``(rows, data, offsets)``: row slices whose ``column`` holds about a megabyte.

    A longer text is a slice of its own; null counts as empty. ``data[offsets[i]:offsets[i + 1]]``
    are the bytes of row i of the slice.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        if text.null_count:
            text = text.fill_null("")
        text = text.cast(pa.large_string())
        _, ends, content = text.buffers()
        ends = np.frombuffer(ends, dtype=np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(content, dtype=np.uint8) if content else np.zeros(0, np.uint8)
        first = 0
        while first < len(text):
            last = int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1
            last = min(max(last, first + 1), len(text))
            low, high = int(ends[first]), int(ends[last])
            yield batch.slice(first, last - first), data[low:high], ends[first : last + 1] - low
            first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple:
    """``(row, start, end)`` of all maximal runs of ``inside`` bytes; runs never cross rows."""
    flags = inside[data]
    if not len(flags):
        none = np.zeros(0, np.int64)
        return none, none, none
    full = offsets[1:] > offsets[:-1]
    before = np.empty_like(flags)
    before[0], before[1:] = False, flags[:-1]
    before[offsets[:-1][full]] = False
    after = np.empty_like(flags)
    after[-1], after[:-1] = False, flags[1:]
    after[offsets[1:][full] - 1] = False
    start = np.flatnonzero(flags & ~before)
    end = np.flatnonzero(flags & ~after) + 1
    return np.searchsorted(offsets, start, "right") - 1, start, end


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the given disjoint, ascending, non-empty byte spans."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    first = np.cumsum(length) - length
    inner = np.arange(int(length.sum())) - np.repeat(first, length)
    powers = np.cumprod(np.full(int(length.max()), _BASE))
    values = _BYTE[data[inner + np.repeat(start, length)]] * powers[inner]
    return mixed(np.add.reduceat(values, first) + length.astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: bool = True) -> tuple:
    """``(row, hash)`` of all words, in order."""
    if lower:
        data = LOWER[data]
    row, start, end = word_spans(data, offsets, inside)
    return row, span_hashes(data, start, end)


def first_of_rows(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each row begins in the ascending ``row``, and the end: ``rows + 1`` positions."""
    return np.searchsorted(row, np.arange(rows + 1))


def list_array(values: pa.Array, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
