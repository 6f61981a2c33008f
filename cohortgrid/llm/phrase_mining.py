"""Phrase collocations from stripes.

A stripe is a prefix with an associative counter of the words that follow
it. Tasks build the stripes of their own texts and merge them before the
shuffle; after it, stripes of one prefix are merged elementwise. One
structure then gives the extensions (a counter's entries are the counts of
the prefix and its next word; those of the empty prefix are the words), the
prefix totals (the entry without a next word, and the counter above) and
the subsumption maxima (the greatest entry of a phrase's own stripe, and of
the stripes whose extension ends in it).

Prefixes grow from none to three words in as many passes. A phrase can occur
``least`` times only if both phrases that it consists of but for its last
and its first word do, so each pass leaves out what a Bloom filter of the
phrases found before says is rarer. The filter has a bounded size; where it
is too small it lets more through, and counts stay exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortgrid.llm.arrays import LOWER, mix, packed, row_slices, span_hashes, utf8, words
from cohortgrid.llm.storage import kept, scratch, written

# Bytes between pieces, and between the words of a piece.
BREAK = np.zeros(256, bool)
BREAK[list(b".,;:!?\n\v\f\r")] = True
GAP = BREAK.copy()
GAP[list(b" \t")] = True

MAX_WORDS = 4
#: A hot prefix's stripe is dealt out over this many parts, by next word.
PARTS = 256
#: A prefix is hot with more than this share of all words; there are at most
#: this many of them.
HOT_PREFIXES = 1000
#: Bytes of text whose stripes are merged in a task.
SLICE = 8 << 20
#: Bits of the largest filter (16 MB), and bits per phrase before that. Tasks
#: hand it on in blocks.
MAX_FILTER_BITS, BITS_PER_PHRASE, BLOCKS = 1 << 27, 16, 64
SALTS = 32
RANK_SALTS = 64

# Next words and their counts, each joined by spaces.
_STRIPE = "lang string, prefix string, part int, nexts string, counts string"


class Slice:
    """The words of some rows: the number of each word (by lang and
    spelling), a 64-bit hash of each number, and whether a word and its
    successor stand in one piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: pa.Array) -> None:
        low = LOWER[data]
        starts, ends, first = words(low, offsets, GAP)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        langs = lang.dictionary_encode()
        spelled = packed(low, starts, ends).dictionary_encode()
        n_spelled = max(len(spelled.dictionary), 1)
        of_row = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        key, number = np.unique(of_row[row] * n_spelled + spelled.indices.to_numpy(zero_copy_only=False), return_inverse=True)
        self.number = number.astype(np.int64)
        self.word = pc.take(spelled.dictionary, pa.array(key % n_spelled)).cast(pa.large_string())
        self.lang_of = key // n_spelled
        self.lang = langs.dictionary.cast(pa.large_string())
        self.hash = phrase_hash([_string_hashes(self.lang)[self.lang_of], _string_hashes(self.word)]) if len(key) else np.zeros(0, np.uint64)
        breaks = np.zeros(len(low) + 1, np.int32)
        np.cumsum(BREAK[low], out=breaks[1:])
        at = breaks[starts]
        self.joined = (row[1:] == row[:-1]) & (at[1:] == at[:-1])


def _string_hashes(strings: pa.Array) -> np.ndarray:
    data, offsets = utf8(strings)
    return span_hashes(data, offsets[:-1], offsets[1:])


def phrase_hash(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of consecutive parts, elementwise."""
    h = parts[0]
    for part in parts[1:]:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + part)
    return h


def _bits(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    """Four bit positions of each hash."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(low + np.uint64(k) * high) & np.uint64(n_bits - 1) for k in range(4)])


def _all_set(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.ones(len(hashes), bool)
    for at in _bits(hashes, len(cells) * 64):
        out &= (cells[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return out


def phrase_hashes(lang: pa.Array, phrase: pa.Array, n_words: int) -> np.ndarray:
    """The hashes of phrases of ``n_words`` words."""
    parts = pc.split_pattern(phrase.cast(pa.large_string()), " ").flatten()
    lang, spelled = _string_hashes(lang), _string_hashes(parts).reshape(-1, n_words)
    return phrase_hash([phrase_hash([lang, spelled[:, k]]) for k in range(n_words)])


def phrase_filter(phrases: DataFrame, n_words: int) -> np.ndarray:
    """A Bloom filter, as 64-bit cells, of (lang, phrase) rows whose phrases
    have ``n_words`` words; at most ``MAX_FILTER_BITS`` reach the driver."""
    n = phrases.count()
    n_bits = 1 << max(12, min(MAX_FILTER_BITS, BITS_PER_PHRASE * max(n, 1)).bit_length() - 1)
    schema = "block int, cells binary"

    def blocks(cells: np.ndarray, of: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(of, pa.int32()), pa.array([c.tobytes() for c in cells], pa.binary())], names=["block", "cells"])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(n_bits // 64, np.uint64)
        for batch in batches:
            at = np.unique(_bits(phrase_hashes(batch.column(0), batch.column(1), n_words), n_bits))
            cell, first = np.unique(at >> np.uint64(6), return_index=True)
            if len(at):
                cells[cell] |= np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
        yield blocks(cells.reshape(BLOCKS, -1), list(range(BLOCKS)))

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own_cells = np.frombuffer(cells.as_buffer(), np.uint64)
                found[block] = found[block] | own_cells if block in found else own_cells
        yield blocks(np.array(list(found.values())), list(found))

    merged_blocks = phrases.select("lang", "phrase").mapInArrow(own, schema).repartition(BLOCKS, "block").mapInArrow(both, schema).toArrow()
    cells = np.zeros((BLOCKS, n_bits // 64 // BLOCKS), np.uint64)
    for block, held in zip(merged_blocks.column("block").to_pylist(), merged_blocks.column("cells").to_pylist(), strict=True):
        cells[block] = np.frombuffer(held, np.uint64)
    return cells.ravel()


def hot_prefixes(phrases: DataFrame, n_words: int, total: int) -> np.ndarray:
    """Hashes of the prefixes (lang, phrase, f) with more than their share of
    ``total`` words; by their counts they are at most ``HOT_PREFIXES`` (and
    langs)."""
    rows = phrases.filter(F.col("f").cast("decimal(38, 0)") * HOT_PREFIXES > total).select("lang", "phrase").toArrow()
    return phrase_hashes(rows.column("lang").combine_chunks(), rows.column("phrase").combine_chunks(), n_words) if len(rows) else np.zeros(0, np.uint64)


def _word_stripes(s: Slice) -> pa.RecordBatch:
    """The empty prefix's stripe for each lang, dealt out, with its total as
    the entry of the empty next word."""
    counts = np.bincount(s.number, minlength=len(s.word))
    totals = np.bincount(s.lang_of[s.number], minlength=len(s.lang)) if len(s.number) else np.zeros(len(s.lang), np.int64)
    langs = np.arange(len(s.lang))
    prefix = np.concatenate([s.lang_of, langs])
    follow = np.concatenate([np.arange(len(s.word)), np.full(len(langs), -1)])
    spelled = pa.array([""] * len(langs), pa.large_string())
    return _stripe_rows(s, prefix, follow, np.concatenate([counts, totals]), spelled, langs, np.ones(len(langs), bool))


def _longer_stripes(s: Slice, cells: np.ndarray, hot: np.ndarray, width: int) -> pa.RecordBatch:
    """Stripes of prefixes of ``width`` words whose words, and whose last
    words with the next, both pass the filter."""
    last, n = len(s.number) - width + 1, max(len(s.word), 1)
    if last < 2:
        return _stripe_rows(s, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), s.word[:0], s.lang_of[:0], np.zeros(0, bool))
    whole = np.ones(last, bool)
    for k in range(width - 1):
        whole &= s.joined[k : k + last]
    at = np.flatnonzero(whole)
    at = at[_all_set(cells, phrase_hash([s.hash[s.number[at + k]] for k in range(width)]))]
    passed = np.zeros(last, bool)
    passed[at] = True
    at = np.flatnonzero(passed[:-1] & passed[1:] & s.joined[: last - 1])
    key = s.number[at]
    for k in range(1, width):
        key = np.unique(key * n + s.number[at + k], return_inverse=True)[1].astype(np.int64)
    key, first, prefix = np.unique(key, return_index=True, return_inverse=True)
    pairs, counts = np.unique(prefix.astype(np.int64) * n + s.number[at + width], return_counts=True)
    sample = at[first]
    columns = [pc.take(s.word, pa.array(s.number[sample + k])) for k in range(width)]
    spelled = pc.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string())) if width > 1 else columns[0]
    is_hot = np.isin(phrase_hash([s.hash[s.number[sample + k]] for k in range(width)]), hot)
    return _stripe_rows(s, pairs // n, pairs % n, counts, spelled, s.lang_of[s.number[sample]], is_hot)


def _stripe_rows(s: Slice, prefix: np.ndarray, follow: np.ndarray, count: np.ndarray, spelled: pa.Array, lang_of: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
    """One row per prefix, or per part of a hot one; ``follow`` -1 is no next
    word."""
    part = np.zeros(len(follow), np.int64)
    dealt = (follow >= 0) & hot[prefix]
    part[dealt] = (s.hash[follow[dealt]] >> np.uint64(40)).astype(np.int64) % PARTS
    order = np.lexsort((follow, part, prefix))
    prefix, part, follow, count = prefix[order], part[order], follow[order], count[order]
    head = np.flatnonzero(np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])])[: len(prefix)])
    bounds = pa.array(np.append(head, len(prefix)).astype(np.int32))
    nexts = pc.fill_null(pc.take(s.word, pa.array(follow, mask=follow < 0)), "").cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [
            pc.take(s.lang, pa.array(lang_of[prefix[head]])).cast(pa.string()),
            pc.take(spelled, pa.array(prefix[head])).cast(pa.string()),
            pa.array(part[head].astype(np.int32)),
            pc.binary_join(pa.ListArray.from_arrays(bounds, nexts), " "),
            pc.binary_join(pa.ListArray.from_arrays(bounds, pa.array(count.astype(np.int64)).cast(pa.string())), " "),
        ],
        names=["lang", "prefix", "part", "nexts", "counts"],
    )


def stripes(docs: DataFrame, of_slice: Callable[[Slice], pa.RecordBatch]) -> DataFrame:
    """The stripes of each slice of the rows (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_slices(offsets, SLICE):
                cut = offsets[lo : hi + 1]
                found = of_slice(Slice(data[cut[0] : cut[-1]], cut - cut[0], batch.column(0)[lo:hi]))
                for at in range(0, len(found), 65536):
                    yield found[at : at + 65536]

    return docs.mapInArrow(run, _STRIPE)


def merged(found: DataFrame, least: int) -> DataFrame:
    """Stripes merged elementwise: (lang, phrase, f) of every extension of at
    least ``least``, and of the empty phrase. The stripes are shuffled whole;
    a hot prefix is dealt out over its parts."""
    dealt = found.repartition("lang", "prefix", "part")
    pairs = F.arrays_zip(F.split("nexts", " ").alias("next"), F.split("counts", " ").alias("n"))
    entries = dealt.select("lang", "prefix", "part", F.explode(pairs).alias("e"))
    summed = entries.groupBy("lang", "prefix", "part", F.col("e.next").alias("next")).agg(F.sum(F.col("e.n").cast("long")).alias("f"))
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    return summed.select("lang", phrase.alias("phrase"), "f").filter((F.col("f") >= least) | (F.col("phrase") == ""))


def frequent_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n_words, f) of all phrases of one to four words with
    f >= ``least``, and (lang, n), the words of each lang. ``docs``: (lang,
    text)."""
    singles = written(merged(stripes(docs, _word_stripes), least), "phrases-1")
    sizes = singles.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    total = int(sizes.agg(F.sum(F.col("n").cast("decimal(38, 0)"))).first()[0] or 0)
    level = singles.filter("phrase != ''").select("lang", "phrase", F.lit(1).alias("n_words"), "f")
    found = level
    for width in range(1, MAX_WORDS):
        cells, hot = phrase_filter(level, width), hot_prefixes(level, width, total)

        def of_slice(s: Slice, cells: np.ndarray = cells, hot: np.ndarray = hot, width: int = width) -> pa.RecordBatch:
            return _longer_stripes(s, cells, hot, width)

        level = written(merged(stripes(docs, of_slice), least).select("lang", "phrase", F.lit(width + 1).alias("n_words"), "f"), f"phrases-{width + 1}")
        found = found.union(level)
    return found, sizes


def _not_subsumed(phrases: DataFrame, share: int) -> DataFrame:
    """Candidates that no longer one subsumes. The maxima over extensions by
    one word decide: a phrase longer by two that holds the candidate occurs
    no more often than the one between them."""
    k = F.col("n_words")
    longer = phrases.filter(k > 2)
    words_ = F.split("phrase", " ")
    inner = F.explode(F.array(F.array_join(F.slice(words_, F.lit(1), k - 1), " "), F.array_join(F.slice(words_, F.lit(2), k - 1), " ")))
    most = longer.select("lang", inner.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept_on = F.col("most").isNull() | (F.col("most").cast("decimal(19,0)") * 100 < F.col("f").cast("decimal(19,0)") * share)
    return phrases.filter(k > 1).join(most, ["lang", "phrase"], "left").filter(kept_on).drop("most")


def _scored(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each candidate. Single words, which many
    candidates share, are looked up over salts."""
    word = lambda c: ~F.col(c).contains(" ")
    salts = F.when(word("of"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    known = phrases.filter(F.col("n_words") < MAX_WORDS).select(F.col("lang").alias("of_lang"), F.col("phrase").alias("of"), "f").select("*", F.explode(salts).alias("of_salt"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    words_ = F.split("phrase", " ")
    cuts = cuts.select(
        "lang", "phrase", F.col("f").alias("a"), "k",
        F.array_join(F.slice(words_, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words_, F.col("k") + 1, F.col("n_words") - F.col("k")), " ").alias("rest"),
    )
    for part, name in (("first", "l"), ("rest", "r")):
        salt = F.when(word(part), F.pmod(F.xxhash64("phrase", "k"), F.lit(SALTS)).cast("int")).otherwise(0)
        cuts = cuts.withColumn("salt", salt).join(known.withColumnRenamed("f", name), (F.col("lang") == F.col("of_lang")) & (F.col(part) == F.col("of")) & (F.col("salt") == F.col("of_salt"))).drop("of_lang", "of", "of_salt", "salt")
    score = F.expr("(cast(a as decimal(19, 0)) * 2000000BD) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))").cast("long")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def _first(rows: DataFrame, groups: list[str], limit: int) -> DataFrame:
    order = W.partitionBy(*groups).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= limit)


def phrase_mining(docs: DataFrame, least: int = 30, share: int = 80, limit: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each lang's first ``limit`` collocations of two to four words: (lang,
    rank, phrase, a, l, r, n, score), by score and ``a`` descending, then
    phrase in byte order.

    Everything is counted per lang over all rows; a null lang is ``und``,
    and so is one with that name. Null and empty texts have no words.
    Candidates occur ``least`` times; one whose words stand inside a longer
    candidate with ``share`` per cent of its occurrences goes. Repeated rows
    count again; other columns are ignored; without candidates there are no
    rows.
    """
    with scratch(docs.sparkSession):
        rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
        phrases, sizes = frequent_phrases(rows, least)
        scored = _scored(_not_subsumed(phrases, share), phrases)
        ranked = _first(_first(scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS))), ["lang", "salt"], limit).drop("salt", "rank"), ["lang"], limit)
        return kept(ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases")
