"""Token-id files: encode documents, write them in the patched
frame-of-reference format in ascending id order, and read them back.

Documents are range-partitioned by id; a task turns its range (a shard)
into segments of about ``SEGMENT_TOKENS`` ids (whole documents). Segments
are stored as binary rows (shard, seq, payload) of a Parquet table, so any
store that Spark can write takes them and commits are atomic.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortgrid.llm.arrays import LOWER, mix, row_slices, span_codes, span_hashes, utf8, words
from cohortgrid.llm.pfor import Segment, encode_segment
from cohortgrid.llm.token_counts import byte_symbols

SEGMENT_TOKENS = 1 << 16
# Of a slice's bytes, its arrays take some fifty times as much.
SLICE = 1 << 20
# What a worker gets at once; Spark's own limit is 10,000 rows or 64 MB.
BATCH = 2 << 20
KNOWN_PIECES = 400_000
KNOWN_IDS = 1 << 22
SEGMENTS = "shard int, seq int, n_tokens long, payload binary"

# A letter or digit and the ASCII punctuation behind it never share a token.
_TAIL = np.zeros(256, bool)
_TAIL[list(b".,!?;:|*&$%#")] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_CHECK_CODES = mix(np.arange(301, 557, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _room(a: np.ndarray, used: int, more: int) -> np.ndarray:
    """``a``, or a larger array that begins with its first ``used`` entries."""
    if used + more <= len(a):
        return a
    out = np.empty(max(2 * len(a), used + more), a.dtype)
    out[:used] = a[:used]
    return out


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all runs on end."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class KnownPieces:
    """Ids of the pieces met so far, in flat arrays: a piece is found by a
    64-bit hash and a second, independent one. A piece keeps its slot while
    pieces come in; only the sorted hashes and their slots are moved. Over
    ``limit`` pieces or ``most_ids`` ids, only pieces that were found again
    stay, or none if they are many, so the table's memory is bounded."""

    def __init__(self, limit: int = KNOWN_PIECES, most_ids: int = KNOWN_IDS) -> None:
        self.limit, self.most_ids = limit, most_ids
        self._clear()

    def _clear(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        # Second hash, start and size, by slot.
        self.entries = [np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.again = np.zeros(0, bool)
        self.pool, self.used = np.zeros(0, np.uint32), 0

    def find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each piece, and whether it is known."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int32), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        slot = self.slots[at]
        known = (self.keys[at] == keys) & (self.entries[0][slot] == checks)
        self.again[slot[known]] = True
        return slot, known

    def make_room(self, n: int) -> bool:
        """Before ``n`` new pieces; whether slots have changed."""
        have = len(self.keys)
        if not have or (have + n <= self.limit and self.used <= self.most_ids):
            return False
        stay = np.flatnonzero(self.again[:have])
        checks, starts, sizes = (x[stay] for x in self.entries)
        ids = int(sizes.sum(dtype=np.int64))
        if 2 * len(stay) > self.limit or len(stay) + n > self.limit or 2 * ids > self.most_ids:
            self._clear()
            return True
        place = np.cumsum(self.again[:have], dtype=np.int32) - 1
        kept = self.again[self.slots]
        self.keys, self.slots = self.keys[kept], place[self.slots[kept]]
        self.pool, self.used = self.pool[_ragged(starts, sizes)], ids
        self.entries = [checks, (np.cumsum(sizes) - sizes).astype(np.int32), sizes]
        self.again = np.zeros(len(stay), bool)
        return True

    def add(self, keys: np.ndarray, checks: np.ndarray, ids: list[list[int]]) -> np.ndarray:
        """Take in new pieces; their slots."""
        have, n = len(self.keys), len(keys)
        sizes = np.fromiter(map(len, ids), np.int32, n)
        total = int(sizes.sum(dtype=np.int64))
        self.pool = _room(self.pool, self.used, total)
        self.pool[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        starts = self.used + np.cumsum(sizes) - sizes
        self.used += total
        slots = np.arange(have, have + n, dtype=np.int32)
        self.entries = [_room(x, have, n) for x in self.entries]
        for x, new in zip(self.entries, (checks, starts, sizes), strict=True):
            x[have : have + n] = new
        self.again = _room(self.again, have, n)
        self.again[have : have + n] = False
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys, self.slots = np.insert(self.keys, at, keys[order]), np.insert(self.slots, at, slots[order])
        return slots


class Encoder:
    """Ids of texts from a word-level tokenizers file.

    Such a file drops white space and never joins characters across it,
    so a text's ids are those of its white-space pieces on end. The pieces of
    a slice of texts are numbered by Arrow, each distinct one that is not yet
    known goes to the library once, and the ids of all are gathered. ASCII
    letters may be lower-cased before, as the file does it too, unless the
    text may hold a special string. A piece of letters only that
    normalisation would leave alone is one pre-token and goes straight to the
    library's BPE model.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        # A task has one core; each thread of the library keeps memory of its own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.alphabet = str.maketrans({chr(b): c for b, c in enumerate(byte_symbols())})
        self.known = KnownPieces()

    def _encode(self, pieces: list[bytes]) -> list[list[int]]:
        rest, tokenize = [], self.model.tokenize
        out: list[list[int]] = [[]] * len(pieces)
        for k, piece in enumerate(pieces):
            if piece.isalpha() and piece.islower():
                symbols = piece.decode()
            else:
                text = piece.decode("utf-8", "replace")
                if not (text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text)):
                    rest.append((k, text))
                    continue
                symbols = piece.decode("latin-1").translate(self.alphabet)
            out[k] = [t.id for t in tokenize(symbols)]
        for lo in range(0, len(rest), 512):
            some = rest[lo : lo + 512]
            found = self.library.encode_batch_fast([text for _, text in some], add_special_tokens=False)
            for (k, _), e in zip(some, found, strict=True):
                out[k] = e.ids
        return out

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes as they are looked up, starts and ends of the pieces, and
        the row of each."""
        low = LOWER[data]
        if b"<|" in data.tobytes():
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                if b"<|" in data[lo:hi].tobytes():
                    low[lo:hi] = data[lo:hi]
        starts, ends, first = words(low, offsets)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        if not len(starts):
            return low, starts, ends, row
        # The last byte of each piece before its tail, if there is one.
        body = np.arange(len(low), dtype=np.int32)
        body[_TAIL[low]] = -1
        core = np.maximum.accumulate(body, out=body)[ends - 1].astype(np.int64)
        cut = np.flatnonzero((core >= starts) & (core < ends - 1) & _ALNUM[low[core]])
        starts = np.insert(starts, cut + 1, core[cut] + 1)
        ends = np.insert(ends, cut, core[cut] + 1)
        row = np.insert(row, cut, row[cut])
        return low, starts, ends, row

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows on end, and how many each row has."""
        n = len(offsets) - 1
        low, starts, ends, row = self._pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        code, distinct = span_codes(low, starts, ends)
        size = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
        spelled = np.frombuffer(distinct.buffers()[2], np.uint8)[size[0] : size[-1]]
        bounds = size - size[0]
        keys = span_hashes(spelled, bounds[:-1], bounds[1:])
        checks = span_hashes(spelled, bounds[:-1], bounds[1:], _CHECK_CODES)
        slot, known = self.known.find(keys, checks)
        if self.known.make_room(len(known) - int(known.sum())):
            slot, known = self.known.find(keys, checks)
        new = np.flatnonzero(~known)
        if len(new):
            slot[new] = self.known.add(keys[new], checks[new], self._encode(distinct.take(pa.array(new)).to_pylist()))
        first, length = self.known.entries[1][slot][code], self.known.entries[2][slot][code]
        ids = self.known.pool[_ragged(first, length)]
        return ids, np.bincount(row, weights=length, minlength=n).astype(np.int64)

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        ids, lengths = self.encode(data, offsets)
        ends = np.cumsum(lengths)
        return [ids[b - n : b].astype("<u4").tobytes() for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]


@cache
def _encoder(path: str) -> Encoder:
    """One for each worker process. A function sent to workers takes copies
    of the module's variables along, of its functions only the names."""
    return Encoder(path)


def _segments(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        shard, seq, start = TaskContext.get().partitionId(), 0, 0
        waiting: list[tuple[list[int | None], np.ndarray, np.ndarray]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, start, held, waiting
            ids = [i for some, _, _ in waiting for i in some]
            payload = encode_segment(ids, np.concatenate([n for _, n, _ in waiting]), np.concatenate([t for _, _, t in waiting]), start)
            row = pa.record_batch([pa.array([shard], pa.int32()), pa.array([seq], pa.int32()), pa.array([held], pa.int64()), pa.array([payload], pa.binary())], ["shard", "seq", "n_tokens", "payload"])
            seq, start, held, waiting = seq + 1, start + held, 0, []
            return row

        for batch in batches:
            data, offsets = utf8(batch.column(1))
            all_ids = batch.column(0).to_pylist()
            for lo, hi in row_slices(offsets, SLICE):
                cut = offsets[lo : hi + 1]
                found, lengths = encoder.encode(data[cut[0] : cut[-1]], cut - cut[0])
                lengths = lengths + 1
                ends = np.cumsum(lengths)
                tokens = np.full(int(ends[-1]), end_id, np.uint32)
                is_end = np.zeros(len(tokens), bool)
                is_end[ends - 1] = True
                tokens[~is_end] = found
                # Whole documents until a segment is full.
                at = 0
                while at < hi - lo:
                    before = int(ends[at - 1]) if at else 0
                    to = min(int(np.searchsorted(ends, before + SEGMENT_TOKENS - held)) + 1, hi - lo)
                    waiting.append((all_ids[lo + at : lo + to], lengths[at:to], tokens[before : int(ends[to - 1])]))
                    held += int(ends[to - 1]) - before
                    at = to
                    if held >= SEGMENT_TOKENS:
                        yield flush()
        if waiting:
            yield flush()

    return run


def write_token_files(docs: DataFrame, tokenizer_path: str, out_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, and write the segments to
    ``out_path`` in ascending id order (null ids first; rows with the same
    id in the order of a hash of their texts, then of the texts, so that an id
    that a third of all rows have is split over tasks). A null text is empty
    and holds only the end id. Other columns are ignored; an empty table
    writes no rows.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = narrow.withColumn("spread", F.xxhash64("text")).repartitionByRange("id", "spread").sortWithinPartitions("id", "spread", "text")
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    conf.set(key, BATCH)
    try:
        ordered.select("id", "text").mapInArrow(_segments(tokenizer_path, end_id), SEGMENTS).write.parquet(out_path)
    finally:
        conf.set(key, before)


def _directory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            segment = Segment(payload.as_py())
            raw = memoryview(segment.tokens().astype("<u4").tobytes())
            ends = np.cumsum(segment.lengths)
            starts = ends - segment.lengths
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.record_batch(
                [pa.array([shard] * len(ends), pa.int32()), pa.array(segment.ids, mask=segment.no_id), pa.array(segment.start + starts), pa.array(segment.lengths), pa.array(sums, pa.int64())],
                ["shard", "id", "within", "n_tokens", "ids_crc32"],
            )


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Decode the files at ``path``; one row per document: (id, start,
    n_tokens, ids_crc32). ``start`` counts the ids of all documents before
    it: its place in its shard, kept in the segment, plus the shard's
    start, from one total per shard."""
    segments = spark.read.parquet(path)
    totals = segments.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    bases = totals.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    rows = segments.select("shard", "payload").mapInArrow(_directory, "shard int, id long, within long, n_tokens long, ids_crc32 long")
    return rows.join(bases, "shard").select(F.col("id").alias(id_col), (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for payload in batch.column(0):
            segment = Segment(payload.as_py())
            tokens, ends = segment.tokens().astype(np.int32), np.cumsum(segment.lengths)
            yield pa.record_batch([pa.array(segment.ids, mask=segment.no_id), pa.ListArray.from_arrays(np.r_[0, ends].astype(np.int32), tokens)], ["id", "tokens"])


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """The documents' ids as arrays: (id, tokens)."""
    rows = spark.read.parquet(path).select("payload").mapInArrow(_documents, "id long, tokens array<int>")
    return rows.withColumnRenamed("id", id_col)
