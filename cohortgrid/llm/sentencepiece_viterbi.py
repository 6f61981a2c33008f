"""SentencePiece encoding by a batched numpy Viterbi, and decoding.

The encoding is the segmentation into the model's pieces with the greatest
sum of scores, as the library's unigram search defines it; characters that
no piece covers become byte pieces. Words of equal length advance
together: hashes of all their substrings of a length probe the sorted
piece keys at once, and maxima over piece lengths store back pointers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgrid.llm.arrays import row_slices, utf8
from cohortgrid.llm.recent import Recent

SPACE_MARK = "▁"
LITERAL_MARK = 0x110000  # a space mark in a text itself: no piece has it
UNKNOWN_PENALTY = 10.0  # fixed value: an unknown character scores this less than the worst piece
KNOWN_WORDS = 200_000
CELLS = 1 << 18
UNKNOWN, INSIDE = -1, -2
FILTER_MASK = np.uint64((1 << 20) - 1)
_WORDS = re.compile(r" *[^ ]+| +$")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """A model's pieces: sorted keys for probing, bytes for decoding."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        texts = [model.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if any(SPACE_MARK in texts[i].lstrip(SPACE_MARK) for i in normal):
            raise ValueError("pieces that cross a word boundary are not supported")
        self.of_byte = {int(texts[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        if len(self.of_byte) != 256:
            raise ValueError("the model has no byte pieces")
        keys = np.array([self._key(texts[i]) for i in normal], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(normal, np.int32)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a key")
        self.filter = np.zeros(int(FILTER_MASK) + 1, bool)
        self.filter[self.keys & FILTER_MASK] = True
        self.scores = np.array([model.get_score(i) for i in normal], np.float64)[order]
        self.unknown_score = self.scores.min() - UNKNOWN_PENALTY
        self.lengths = sorted({len(texts[i]) for i in normal}, reverse=True)
        self.bytes = [bytes([int(t[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) or model.is_unknown(i) else t.replace(SPACE_MARK, " ").encode() for i, t in enumerate(texts)]

    @staticmethod
    def _key(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(_FACTOR) + ord(c) + 1) & (1 << 64) - 1
        return h


def _probe(pieces: Pieces, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the pieces with these keys; -inf and -1 where
    there is none. A small table of key bits spares most searches."""
    score, piece = np.full(keys.shape, -np.inf), np.full(keys.shape, -1, np.int32)
    maybe = np.flatnonzero(pieces.filter[keys & FILTER_MASK])
    own = keys.ravel()[maybe]
    at = np.searchsorted(pieces.keys, own)
    at[at == len(pieces.keys)] = 0
    hit = pieces.keys[at] == own
    score.ravel()[maybe[hit]], piece.ravel()[maybe[hit]] = pieces.scores[at[hit]], pieces.ids[at[hit]]
    return score, piece


def viterbi(points: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Best segmentations of equally long words, a column of code points
    each. The result has at each piece's first character its id, or
    UNKNOWN for a character without a piece, and elsewhere INSIDE."""
    length, n = points.shape
    keys, found = np.zeros((length, n), np.uint64), {}
    codes = points.astype(np.uint64) + np.uint64(1)
    for k in range(1, min(length, pieces.lengths[0]) + 1):
        keys = keys[: length - k + 1] * _FACTOR + codes[k - 1 :]
        if k == 1 or k in pieces.lengths:
            found[k] = _probe(pieces, keys)
    found[1][0][found[1][1] < 0] = pieces.unknown_score
    best = np.full((length + 1, n), -np.inf)
    best[0] = 0
    step = np.zeros((length + 1, n), np.int32)
    for end in range(1, length + 1):
        # Longest first: of equal sums the earliest start stays.
        for k in sorted(found, reverse=True):
            if k <= end:
                total = best[end - k] + found[k][0][end - k]
                better = total > best[end]
                best[end][better] = total[better]
                step[end][better] = k
    out = np.full((length, n), INSIDE, np.int32)
    at, alive = np.full(n, length), np.arange(n)
    while len(alive):
        took = step[at[alive], alive]
        at[alive] -= took
        for k in np.unique(took):
            own = alive[took == k]
            out[at[own], own] = found[int(k)][1][at[own], own]
        alive = alive[at[alive] > 0]
    return out


class Encoder:
    """Ids of texts. A space starts a word that no piece crosses, so words
    are encoded apart, and recent words are kept."""

    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self.known = Recent(KNOWN_WORDS)

    def _with_bytes(self, ids: np.ndarray, points: np.ndarray) -> bytes:
        """One word's ids, each character without a piece as its bytes."""
        out: list[int] = []
        for i, point in zip(ids.tolist(), points.tolist(), strict=True):
            if i >= 0:
                out.append(i)
            elif i == UNKNOWN:
                char = SPACE_MARK if point == LITERAL_MARK else chr(point)
                out += [self.pieces.of_byte[b] for b in char.encode("utf-8", "surrogatepass")]
        return np.array(out, "<i4").tobytes()

    def _learn(self, words: set[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for word in self.known.missing(words):
            # A word without a space in front starts with one.
            by_length.setdefault(len(word) + (word[:1] != " "), []).append(word)
        for length, some in by_length.items():
            columns = max(1, CELLS // length)
            for lo in range(0, len(some), columns):
                part = some[lo : lo + columns]
                text = "".join([w if w[:1] == " " else " " + w for w in part])
                points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
                points = np.ascontiguousarray(points.reshape(len(part), length).T)
                points[points == ord(SPACE_MARK)] = LITERAL_MARK
                points[points == ord(" ")] = ord(SPACE_MARK)
                ids = viterbi(points, self.pieces).T
                flat, ends = ids[ids >= 0].astype("<i4"), np.cumsum((ids >= 0).sum(axis=1)).tolist()
                start = 0
                for word, end in zip(part, ends, strict=True):
                    self.known.young[word] = flat[start:end].tobytes()
                    start = end
                for k in np.flatnonzero((ids == UNKNOWN).any(axis=1)).tolist():
                    self.known.young[part[k]] = self._with_bytes(ids[k], points[:, k])

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = []
        for text in texts:
            if not text:
                split.append([])
            elif "  " in text or text[0] == " " or text[-1] == " ":
                # A word with one space in front has the key without it.
                found = _WORDS.findall(" " + text)
                split.append([w if w.startswith("  ") else w[1:] for w in found])
            else:
                split.append(text.split(" "))
        self._learn(set().union(*split))
        known = self.known.young
        return [b"".join(map(known.__getitem__, words)) for words in split]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def decode_ids(ids: list[int], pieces: Pieces) -> str:
    """The text of ids; the space in front of the first word is dropped."""
    raw = b"".join([pieces.bytes[i] for i in ids])
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def _encode(path: str, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            for lo, hi in row_slices(offsets, 1 << 20):
                texts = batch.column(1)[lo:hi].fill_null("").to_pylist()
                coded = encode(texts)
                flat = np.frombuffer(b"".join(coded), "<i4")
                sizes = np.fromiter((len(c) // 4 for c in coded), np.int64, len(coded))
                ends = np.r_[0, np.cumsum(sizes)]
                columns = [batch.column(0)[lo:hi], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]
                names = ["row", "ids"]
                if check:
                    numbers = flat.tolist()
                    back = [decode_ids(numbers[a:b], encode.pieces) == t for a, b, t in zip(ends[:-1].tolist(), ends[1:].tolist(), texts, strict=True)]
                    columns.append(pa.array(back))
                    names.append("round_trip")
                yield pa.record_batch(columns, names)

    return run


def encode(docs: DataFrame, model_path: str, check: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, ids), and with ``check`` whether the
    decoded ids are the text again (round_trip).

    ``model_path`` is a SentencePiece file with byte pieces that every
    executor can read; its scores define the search whatever its type. Texts
    are taken as they are (a space in front, spaces as marks, no other
    normalisation). A null or empty text has no ids; ids of rows may be
    null or repeated; other columns are ignored. One pass, no shuffle.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = "row long, ids array<int>" + ", round_trip boolean" * check
    return narrow.mapInArrow(_encode(model_path, check), kind).withColumnRenamed("row", id_col)


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _encoder(path).pieces
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [decode_ids(ids or [], pieces) for ids in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(texts, pa.string())], ["row", "text"])

    return run


def decode(coded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: (id, text). Null or empty ids give an empty
    text; byte pieces that are no UTF-8 give replacement characters."""
    narrow = coded.select(F.col(id_col).cast("long").alias("row"), F.col(ids_col).cast("array<int>").alias("ids"))
    return narrow.mapInArrow(_decode(model_path), "row long, text string").withColumnRenamed("row", id_col)
