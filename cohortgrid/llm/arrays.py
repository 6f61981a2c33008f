"""Flat numpy views of Arrow string columns, shared by the operators.

A text column of a batch is one byte array with row offsets, so that byte
classes, words and hashes are whole-array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    buffers = col.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[col.offset : col.offset + len(col) + 1]
    if buffers[2] is None or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes; a longer row is a
    range of its own, so rows are never cut."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply) over a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier modulo 2**64, and of its inverse."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, min(2 * n, SLICE_BYTES + 1))
        inverse = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
        for name, base in (("up", _MULTIPLIER), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = _BYTE_CODES) -> np.ndarray:
    """64-bit hashes of the byte spans ``data[start:end]``: a polynomial
    in the bytes' codes from prefix sums, then mixed with the length."""
    up, down = _power_tables(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(codes[data] * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of non-space bytes, and for each row
    the index of its first word (one entry more than rows). ``space`` marks
    the bytes that separate words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~space[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] |= inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] |= inside[tails]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """The byte spans (ascending, not empty, not overlapping) as an Arrow
    array."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] = 1
    edge[ends] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))])


def span_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """Equal spans get equal numbers; also the distinct spans by number."""
    coded = packed(data, starts, ends).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
