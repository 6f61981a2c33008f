"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch are ragged numpy arrays of symbols. In each round
every sequence merges all occurrences of its own lowest-rank pair at once;
sequences with no known pair left retire with their symbol count.

Text is first cut before each single space that precedes a non-space
character: the pre-token pattern starts a new pre-token there whatever
stands around, so a piece's count does not depend on its neighbours and a
bounded table of recent pieces saves merging the same piece again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgrid.llm.arrays import row_slices
from cohortgrid.llm.recent import Recent

# Fixed value: the byte-level pre-token pattern of the tokenizer family.
PRE_TOKEN = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

_CUT = re.compile(r" (?=\S)")
_GAP = re.compile(r" (?!\S)")
NO_PAIR = np.int32(2**31 - 1)
KNOWN_PIECES = 200_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others follow in
    order from U+0100."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    moved = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(moved)) for b in range(256)]


class Merges:
    """Merge ranks of a byte-level BPE file as sorted arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        keys = left << 32 | right
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.order]
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.of_byte = np.array([vocab[c] for c in byte_symbols()], np.int32)
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that strip or match words are not supported")
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair, NO_PAIR where there is no merge."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.order[at], NO_PAIR)


def count_symbols(words: list[bytes], merges: Merges) -> np.ndarray:
    """Symbols that survive merging, per word (words are not empty)."""
    counts = np.zeros(len(words), np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    symbols = merges.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), sizes)
    rank = np.full(len(symbols), NO_PAIR, np.int32)
    inner = np.flatnonzero(owner[:-1] == owner[1:])
    rank[inner] = merges.ranks(symbols[inner], symbols[inner + 1])
    while len(symbols):
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lengths = np.diff(np.r_[heads, len(symbols)])
        lowest = np.minimum.reduceat(rank, heads)
        done = lowest == NO_PAIR
        if done.any():
            counts[owner[heads[done]]] = lengths[done]
            stay = np.repeat(~done, lengths)
            symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
            lowest, lengths = lowest[~done], lengths[~done]
            if not len(symbols):
                break
        hit = rank == np.repeat(lowest, lengths)
        # Of overlapping hits (a pair of equal symbols in a run) every second counts.
        chained = np.flatnonzero(hit[1:] & hit[:-1]) + 1
        if len(chained):
            at = np.flatnonzero(hit)
            first = np.r_[True, np.diff(at) > 1]
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            hit[at[nth % 2 == 1]] = False
        at = np.flatnonzero(hit)
        symbols[at] = merges.merged[rank[at]]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
        at -= np.arange(len(at))
        touched = np.unique(np.r_[at, np.maximum(at - 1, 0)])
        last = len(symbols) - 1
        nxt = np.minimum(touched + 1, last)
        joined = (touched < last) & (owner[touched] == owner[nxt])
        rank[touched] = np.where(joined, merges.ranks(symbols[touched], symbols[nxt]), NO_PAIR)
    return counts


class Counter:
    """Counts tokens of texts with one merge table."""

    def __init__(self, path: str) -> None:
        self.merges = Merges(path)
        #: Count of " " + piece by piece; of a text's first piece by ("", piece).
        self.known = Recent(KNOWN_PIECES)

    def _learn(self, pieces: set) -> None:
        new = self.known.missing(pieces)
        words: list[bytes] = []
        per_piece = []
        for p in new:
            found = PRE_TOKEN.findall(" " + p if isinstance(p, str) else p[1])
            per_piece.append(len(found))
            words += [w.encode() for w in found]
        if not words:
            self.known.young.update(dict.fromkeys(new, 0))
            return
        unique = list(dict.fromkeys(words))
        place = dict(zip(unique, range(len(unique)), strict=True))
        counts = count_symbols(unique, self.merges)[[place[w] for w in words]]
        ends = np.cumsum(per_piece)
        total = np.r_[0, np.cumsum(counts)]
        self.known.young.update(zip(new, (total[ends] - total[ends - per_piece]).tolist(), strict=True))

    def __call__(self, texts: list[str]) -> list[int]:
        split, extra, parts_of = [], [], []
        for text in texts:
            parts = [text]
            if self.merges.special and self.merges.special.search(text):
                parts = self.merges.special.split(text)
            extra.append(len(parts) - 1)
            own = []
            for part in parts:
                if part:
                    pieces = _CUT.split(part) if _GAP.search(part) else part.split(" ")
                    # A part that starts with a space and a character starts with a whole piece.
                    head = ("", pieces[0]) if pieces[0] else None
                    own.append((head, pieces[1:]))
            parts_of.append(own)
            split += own
        unique: set = set()
        for head, pieces in split:
            unique.update(pieces)
            if head:
                unique.add(head)
        self._learn(unique)
        known = self.known.young
        return [n + sum(sum(map(known.__getitem__, pieces)) + (known[head] if head else 0) for head, pieces in own) for n, own in zip(extra, parts_of, strict=True)]


_counters: dict[str, Counter] = {}


def _count_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(path)
        count = _counters[path]
        for batch in batches:
            texts = batch.column(1).fill_null("")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            n_tokens: list[int] = []
            for lo, hi in row_slices(np.r_[0, np.cumsum(sizes)], 1 << 20):
                n_tokens += count(texts[lo:hi].to_pylist())
            yield pa.record_batch([batch.column(0), pa.array(sizes), pa.array(n_tokens, pa.int64())], ["id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, n_bytes, n_tokens, over_limit).

    ``tokenizer_path`` is a byte-level BPE file that every executor can
    read. Counts equal the library's without added begin or end tokens;
    special strings inside a text count as one token each. A null or empty
    text has 0 tokens; ids (null too) and repeated rows pass through, other
    columns are ignored. The work is one pass without a shuffle.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = narrow.mapInArrow(_count_batches(tokenizer_path), "id long, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
