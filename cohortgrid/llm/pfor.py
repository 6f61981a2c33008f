"""Patched frame-of-reference coding of token ids.

A segment holds whole documents: a document directory, then blocks of
``BLOCK`` ids. A block stores its minimum, its ids less the minimum packed
at the width that a percentile of them needs, and the ids over that width
in an exception list (position, high part). Block starts are indexed, so
any block can be read alone. All numbers are little-endian.

    header    magic "PFB1", version u16, block u16, documents u32,
              start u64 (ids of all documents before it in its shard), ids u64
    directory per document: id i64, null flag u8, length u32
    blocks    per block: minimum u32, width u8, exceptions u16
    index     blocks + 1 starts u32, into what follows
    data      per block: packed ids, exception positions u16, high parts u32
"""

from __future__ import annotations

import struct

import numpy as np

# Fixed values of the file format.
MAGIC, VERSION, BLOCK = b"PFB1", 1, 256
HEADER = struct.Struct("<4sHHIQQ")


def bit_width(x: np.ndarray) -> np.ndarray:
    """Bits that each of the non-negative integers needs (0 for 0)."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def _lanes(width: int):
    """Of 32 numbers of ``width`` bits packed in ``width`` words: place,
    word and shift of each, and whether it runs on into the next word."""
    for k in range(32):
        word, shift = divmod(k * width, 32)
        yield k, word, np.uint32(shift), shift + width > 32


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of numbers (a multiple of 32) as rows of packed bytes."""
    lanes = values.reshape(len(values), -1, 32)
    out = np.zeros((*lanes.shape[:2], width), "<u4")
    low = np.uint32((1 << width) - 1)
    for k, word, shift, runs_on in _lanes(width):
        value = lanes[:, :, k] & low
        out[:, :, word] |= value << shift
        if runs_on:
            out[:, :, word + 1] |= value >> (np.uint32(32) - shift)
    return out.reshape(len(values), -1).view(np.uint8)


def unpack(raw: np.ndarray, width: int) -> np.ndarray:
    """The inverse of ``pack``."""
    words = np.ascontiguousarray(raw).view("<u4").reshape(len(raw), -1, width)
    out = np.empty((*words.shape[:2], 32), np.uint32)
    low = np.uint32((1 << width) - 1)
    for k, word, shift, runs_on in _lanes(width):
        value = words[:, :, word] >> shift
        if runs_on:
            value = value | words[:, :, word + 1] << (np.uint32(32) - shift)
        out[:, :, k] = value & low
    return out.reshape(len(raw), -1)


def encode_segment(ids: list[int | None], lengths: np.ndarray, tokens: np.ndarray, start: int, percentile: float = 0.9) -> bytes:
    """One segment's bytes; ``tokens`` are the documents' ids on end."""
    n_blocks = -(-len(tokens) // BLOCK)
    grid = np.empty(n_blocks * BLOCK, np.uint32)
    grid[: len(tokens)] = tokens
    if len(tokens):
        grid[len(tokens) :] = tokens[-1]
    grid = grid.reshape(n_blocks, BLOCK)
    low = grid.min(axis=1) if n_blocks else np.zeros(0, np.uint32)
    rest = grid - low[:, None]
    at = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    widths = bit_width(np.partition(rest, at, axis=1)[:, at]) if n_blocks else np.zeros(0, np.int64)
    over = (rest >> widths.astype(np.uint32)[:, None]) > 0 if n_blocks else np.zeros((0, BLOCK), bool)
    exceptions = over.sum(axis=1)

    packed: list[bytes] = [b""] * n_blocks
    for width in np.unique(widths):
        if width:
            own = np.flatnonzero(widths == width)
            for k, row in zip(own.tolist(), pack(rest[own], int(width)), strict=True):
                packed[k] = row.tobytes()
    block_of, position = np.nonzero(over)
    high = (rest[block_of, position] >> widths.astype(np.uint32)[block_of]).astype("<u4")
    position = position.astype("<u2")
    ends = np.cumsum(exceptions)
    for k in np.flatnonzero(exceptions).tolist():
        own = slice(ends[k] - exceptions[k], ends[k])
        packed[k] += position[own].tobytes() + high[own].tobytes()
    starts = np.zeros(n_blocks + 1, "<u4")
    np.cumsum(widths * (BLOCK // 8) + exceptions * 6, out=starts[1:])
    return b"".join(
        [
            HEADER.pack(MAGIC, VERSION, BLOCK, len(ids), start, len(tokens)),
            np.array([0 if i is None else i for i in ids], "<i8").tobytes(),
            np.array([i is None for i in ids], np.uint8).tobytes(),
            lengths.astype("<u4").tobytes(),
            low.astype("<u4").tobytes(),
            widths.astype(np.uint8).tobytes(),
            exceptions.astype("<u2").tobytes(),
            starts.tobytes(),
            *packed,
        ]
    )


class Segment:
    """A parsed segment: its directory, and its blocks on demand."""

    def __init__(self, payload: bytes) -> None:
        magic, version, block, n_docs, self.start, self.n_tokens = HEADER.unpack_from(payload)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a segment of this format")
        self.block, self.at = block, HEADER.size
        self.payload = payload
        self.ids = self._take("<i8", n_docs)
        self.no_id = self._take(np.uint8, n_docs).astype(bool)
        self.lengths = self._take("<u4", n_docs).astype(np.int64)
        n_blocks = -(-self.n_tokens // block)
        self.low = self._take("<u4", n_blocks)
        self.widths = self._take(np.uint8, n_blocks).astype(np.int64)
        self.exceptions = self._take("<u2", n_blocks).astype(np.int64)
        self.starts = self._take("<u4", n_blocks + 1).astype(np.int64)
        self.data = np.frombuffer(payload, np.uint8, offset=self.at)

    def _take(self, kind, n: int) -> np.ndarray:
        out = np.frombuffer(self.payload, kind, n, self.at)
        self.at += out.nbytes
        return out

    def blocks(self, lo: int, hi: int) -> np.ndarray:
        """The ids of blocks lo to hi - 1, a row each (the last is padded)."""
        widths, out = self.widths[lo:hi], np.zeros((hi - lo, self.block), np.uint32)
        for width in np.unique(widths):
            if width:
                own = np.flatnonzero(widths == width)
                raw = self.data[self.starts[lo + own][:, None] + np.arange(width * (self.block // 8))]
                out[own] = unpack(raw, int(width))
        for k in np.flatnonzero(self.exceptions[lo:hi]).tolist():
            n, at = int(self.exceptions[lo + k]), int(self.starts[lo + k] + widths[k] * (self.block // 8))
            position = self.data[at : at + 2 * n].view("<u2")
            high = self.data[at + 2 * n : at + 6 * n].view("<u4")
            out[k, position] |= high << np.uint32(widths[k])
        return out + self.low[lo:hi, None]

    def tokens(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids lo to hi - 1 of the segment, reading only their blocks."""
        hi = self.n_tokens if hi is None else hi
        if hi <= lo:
            return np.zeros(0, np.uint32)
        first, last = lo // self.block, -(-hi // self.block)
        return self.blocks(first, last).ravel()[lo - first * self.block : hi - first * self.block]
