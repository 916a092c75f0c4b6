"""Words, shingles and their hashes for whole Arrow batches, without a Python loop over words.

Texts are cut at single bytes below 0x80, so UTF-8 sequences stay whole.  All hashes are 64 bits
wide and do not depend on batch, task or machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
CHUNK_BYTES = 1 << 20

# White space that separates words, as the contracts state it.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def times(a: int, b: int) -> np.uint64:
    """Product of two scalars modulo 2**64."""
    return U64(int(a) * int(b) & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * _M1
    x = x ^ (x >> U64(27))
    x = x * _M2
    return x ^ (x >> U64(31))


BYTE_CODE = mix((np.arange(256, dtype=U64) + U64(1)) * GOLDEN) | U64(1)
_powers = np.ones(1, U64)


def powers(n: int) -> np.ndarray:
    global _powers
    while len(_powers) < n:
        step = times(_powers[-1], GOLDEN)
        _powers = np.concatenate([_powers, _powers * step])
    return _powers[:n]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and n+1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset:filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes together; one longer text is a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        stop = min(n, max(row + 1, stop))
        yield row, stop
        row = stop


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end and row of each word, in order; words never cross rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separators[data]
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[offsets[:-1][filled]] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][filled] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    row = filled[np.searchsorted(offsets[:-1][filled], start, side="right") - 1]
    return start, end, row


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word's bytes; the words must not overlap and be in order."""
    if not len(start):
        return np.zeros(0, U64)
    length = end - start
    first = np.cumsum(length) - length
    within = np.arange(int(length.sum())) - np.repeat(first, length)
    value = BYTE_CODE[data[within + np.repeat(start, length)]] * powers(int(length.max()))[within]
    return mix(np.add.reduceat(value, first) + length.astype(U64) * _M1)


def shingles(hashes: np.ndarray, row: np.ndarray, width: int, short: bool = True
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word of each run of ``width`` words of a row, in order.

    With ``short``, a row of fewer words has its whole sequence as one shingle.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    value = np.zeros(max(0, n - width + 1), U64)
    for k in range(width):
        value = value * GOLDEN + mix(hashes[k:n - width + 1 + k] + U64(k)) if len(value) else value
    at = np.flatnonzero(row[:len(value)] == row[width - 1:]) if len(value) else np.zeros(0, np.int64)
    value, of = mix(value[at] + U64(width)), row[at]
    if short:
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        count = np.diff(np.r_[first, n])
        for size in range(1, width):
            begin = first[count == size]
            part = np.zeros(len(begin), U64)
            for k in range(size):
                part = part * GOLDEN + mix(hashes[begin + k] + U64(k))
            value, of = np.r_[value, mix(part + U64(size))], np.r_[of, row[begin]]
            at = np.r_[at, begin]
        order = np.argsort(of, kind="stable")
        value, of, at = value[order], of[order], at[order]
    return value, of, at


def distinct(value: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row; rows must be in order."""
    if not len(value):
        return value, row
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    value = value.copy()
    for a, b in zip(first, np.r_[first[1:], len(row)], strict=True):
        value[a:b].sort()
    new = np.r_[True, (value[1:] != value[:-1]) | (row[1:] != row[:-1])]
    return value[new], row[new]


def sequence_keys(hashes: np.ndarray, row: np.ndarray, n_rows: int) -> list[bytes]:
    """A 128-bit key of each row's word sequence."""
    out = np.zeros((n_rows, 2), U64)
    if len(row):
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        count = np.diff(np.r_[first, len(row)])
        within = np.arange(len(row)) - np.repeat(first, count)
        power = powers(int(count.max()))[within]
        for k in range(2):
            total = np.add.reduceat(mix(hashes ^ times(k + 1, _M2)) * power, first)
            out[row[first], k] = mix(total + count.astype(U64) * GOLDEN)
    flat = out.astype("<u8").tobytes()
    return [flat[16 * i:16 * i + 16] for i in range(n_rows)]
