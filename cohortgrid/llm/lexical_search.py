"""Ranked lexical search by a document FP-tree.

Documents are reduced to the terms that some query item holds (restricted
term vectors, with their frequencies). The vectors of a chunk of documents
are put in order of the terms' document frequency, most frequent first, and
laid into a prefix tree, in which documents that start with the same terms
share a path. Every node knows, for each term of its subtree, the greatest
frequency, and the least length norm m of its documents: together they bound
the score of any document below. Each item then walks the tree depth first,
best bound first, and leaves out what cannot reach its current k-th score.

The tree is built level by level over numpy arrays. A path ends in a leaf
where ``leaf`` documents or fewer are left, or where their terms end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortgrid.llm.arrays import LOWER, row_slices, span_hashes, utf8, words
from cohortgrid.llm.storage import kept, scratch, written

#: Bytes between terms: all ASCII but letters and digits.
BETWEEN = np.ones(256, bool)
BETWEEN[0x80:] = False
BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False

#: Documents of a leaf, term entries of a tree, characters of a query block.
LEAF, CHUNK_ENTRIES, BLOCK_CHARS = 64, 2_000_000, 16 << 20
#: Salted groups of the first merge of the tasks' results.
MERGE_SALTS = 64


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with starts, ends and row bounds of the terms."""
    low = LOWER[data]
    return (low, *words(low, offsets, BETWEEN))


def terms_of(text: str | None) -> list[bytes]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    low, starts, ends, _ = term_spans(raw, np.array([0, len(raw)], np.int64))
    whole = low.tobytes()
    return [whole[a:b] for a, b in zip(starts, ends, strict=True)]


class Vocabulary:
    """The terms of the query items, found by hash and compared in full."""

    def __init__(self, terms: list[bytes]) -> None:
        joined = np.frombuffer(b"".join(terms), np.uint8)
        size = np.array([len(t) for t in terms], np.int64)
        end = np.cumsum(size)
        hashes = span_hashes(joined, end - size, end) if terms else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two terms share a hash")
        self.joined, self.hashes, self.term = joined, hashes[order], order
        self.start, self.size = (end - size)[order], size[order]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The spans that are terms (their positions), and which."""
        if not len(self.hashes) or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = span_hashes(data, starts, ends)
        slot = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        at = np.flatnonzero((self.hashes[slot] == hashes) & (self.size[slot] == ends - starts))
        slot = slot[at]
        size = self.size[slot]
        bounds = np.zeros(len(at) + 1, np.int64)
        np.cumsum(size, out=bounds[1:])
        step = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size)
        differs = data[np.repeat(starts[at], size) + step] != self.joined[np.repeat(self.start[slot], size) + step]
        wrong = np.zeros(len(differs) + 1, np.int64)
        np.cumsum(differs, out=wrong[1:])
        same = wrong[bounds[1:]] == wrong[bounds[:-1]]
        return at[same], self.term[slot[same]]


def restricted(docs: DataFrame, vocabulary: Vocabulary, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs) per row: its number of terms, and the terms of
    the vocabulary with their frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_slices(offsets):
                cut = offsets[lo : hi + 1]
                low, starts, ends, first = term_spans(data[cut[0] : cut[-1]], cut - cut[0])
                at, term = vocabulary.find(low, starts, ends)
                row = np.searchsorted(first, at, "right") - 1
                width = max(len(vocabulary.hashes), 1)
                keys, count = np.unique(row * width + term, return_counts=True)
                bounds = np.searchsorted(keys, np.arange(hi - lo + 1) * width).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(v)) for v in ((keys % width).astype(np.int32), count.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(np.diff(first).astype(np.int64)), *lists], names=["id", "n", "terms", "tfs"])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "id long, n long, terms array<int>, tfs array<long>")


@dataclass
class Tree:
    """Nodes and documents of one chunk, each with its entries (term, part
    of the score that is not the item's); a node's are upper bounds. Node 0
    is the root; children of a node and documents of a node are contiguous."""

    child: np.ndarray  # first child of each node, one more at the end
    held: np.ndarray  # first own document of each node, one more at the end
    node_ptr: np.ndarray
    node_term: np.ndarray
    node_part: np.ndarray
    doc_ptr: np.ndarray
    doc_term: np.ndarray
    doc_part: np.ndarray
    doc_id: np.ndarray


def score_part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Grows with tf and falls with m, also after rounding down."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def build_tree(ptr: np.ndarray, rank: np.ndarray, tf: np.ndarray, m: np.ndarray, doc_id: np.ndarray, leaf: int = LEAF) -> Tree:
    """``rank``: each document's terms, ascending, 0 the most frequent."""
    n, width = len(m), int(rank.max(initial=0)) + 1
    size = np.diff(ptr)
    at = np.zeros(n, np.int64)  # node of each document
    parents = [np.array([-1])]
    base, depth = 1, 0
    open_ = np.arange(n)
    while len(open_):
        open_ = open_[size[open_] > depth]
        crowded = np.bincount(at[open_], minlength=base) > leaf
        open_ = open_[crowded[at[open_]]]
        if not len(open_):
            break
        keys, which = np.unique(at[open_] * width + rank[ptr[open_] + depth], return_inverse=True)
        parents.append(keys // width)
        at[open_] = base + which
        base += len(keys)
        depth += 1
    parent = np.concatenate(parents)
    first_of_level = np.cumsum([0, *map(len, parents)])
    # Documents by node; entries with the documents.
    order = np.argsort(at, kind="stable")
    at, size = at[order], size[order]
    bounds = np.zeros(n + 1, np.int64)
    np.cumsum(size, out=bounds[1:])
    source = np.arange(bounds[-1]) + np.repeat(ptr[:-1][order] - bounds[:-1], size)
    rank, tf, m = rank[source], tf[source], m[order]
    doc = np.repeat(np.arange(n), size)
    # Subtree minima of m, then maxima of tf, from the deepest level up.
    least = np.full(base, np.iinfo(np.int64).max)
    np.minimum.at(least, at, m)
    for level in range(len(parents) - 1, 0, -1):
        lo, hi = first_of_level[level], first_of_level[level + 1]
        np.minimum.at(least, parent[lo:hi], least[lo:hi])
    held = np.searchsorted(at, np.arange(base + 1))
    own_key = at[doc] * width + rank
    key, most, tables = own_key[:0], tf[:0], []
    for level in range(len(parents) - 1, -1, -1):
        own = slice(bounds[held[first_of_level[level]]], bounds[held[first_of_level[level + 1]]])
        key, most = _maxima(np.concatenate([own_key[own], key]), np.concatenate([tf[own], most]))
        tables.append((key, most))
        key = parent[key // width] * width + key % width
    node_key = np.concatenate([k for k, _ in reversed(tables)])
    node_tf = np.concatenate([t for _, t in reversed(tables)])
    node = node_key // width
    return Tree(
        child=np.searchsorted(parent, np.arange(base + 1)),
        held=held,
        node_ptr=np.searchsorted(node, np.arange(base + 1)),
        node_term=node_key % width,
        node_part=score_part(node_tf, least[node]),
        doc_ptr=bounds,
        doc_term=rank,
        doc_part=score_part(tf, m[doc]),
        doc_id=doc_id[order],
    )


def _maxima(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their greatest value."""
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    return key[first], np.maximum.reduceat(value, first) if len(first) else value


def _sums(ptr: np.ndarray, parts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(parts) + 1, np.int64)
    np.cumsum(parts, out=total[1:])
    return total[ptr[1:] - ptr[0]] - total[ptr[:-1] - ptr[0]]


class Best:
    """The k highest (score, then smallest id) so far, in that order."""

    def __init__(self, k: int) -> None:
        self.k, self.score, self.id = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """The score that a document needs to enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc_id: np.ndarray) -> None:
        good = score >= self.least()
        if good.any():
            score, doc_id = np.concatenate([self.score, score[good]]), np.concatenate([self.id, doc_id[good]])
            order = np.lexsort((doc_id, -score))[: self.k]
            self.score, self.id = score[order], doc_id[order]


def search(tree: Tree, weight: np.ndarray, best: Best) -> int:
    """Depth-first branch and bound of one item over one tree; ``weight``
    has the item's weight of each term. Returns the nodes it opened."""
    stack, opened = [(np.iinfo(np.int64).max, 0)], 0
    while stack:
        bound, node = stack.pop()
        if bound < best.least():
            continue
        opened += 1
        lo, hi = tree.held[node], tree.held[node + 1]
        while hi == lo and tree.child[node + 1] - tree.child[node] == 1:  # a path without branches has one bound
            node = tree.child[node]
            lo, hi = tree.held[node], tree.held[node + 1]
        if hi > lo:
            entries = slice(tree.doc_ptr[lo], tree.doc_ptr[hi])
            best.add(_sums(tree.doc_ptr[lo : hi + 1], weight[tree.doc_term[entries]] * tree.doc_part[entries]), tree.doc_id[lo:hi])
        lo, hi = tree.child[node], tree.child[node + 1]
        if hi > lo:
            entries = slice(tree.node_ptr[lo], tree.node_ptr[hi])
            bounds = _sums(tree.node_ptr[lo : hi + 1], weight[tree.node_term[entries]] * tree.node_part[entries])
            for k in np.argsort(bounds, kind="stable"):
                if bounds[k] >= best.least():
                    stack.append((int(bounds[k]), int(lo + k)))
    return opened


def _search_rows(vectors: DataFrame, rank: np.ndarray, items: list[tuple[int, np.ndarray, np.ndarray]], width: int, k: int) -> DataFrame:
    """The k best documents of each item in each task; ``vectors`` has each
    document's id, norm m, terms and frequencies. A null id sorts last."""
    last = np.iinfo(np.int64).max

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[Tree]:
        waiting: list[pa.RecordBatch] = []
        entries = 0
        for batch in batches:
            waiting.append(batch)
            entries += len(batch.column(2).flatten())
            if entries >= CHUNK_ENTRIES:
                yield tree_of(waiting)
                waiting, entries = [], 0
        if entries:
            yield tree_of(waiting)

    def tree_of(waiting: list[pa.RecordBatch]) -> Tree:
        rows = pa.Table.from_batches(waiting).combine_chunks()
        terms = rows.column("terms").combine_chunks()
        size = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ptr = np.concatenate([[0], np.cumsum(size)])
        ranks = rank[terms.flatten().to_numpy()]
        tf = rows.column("tfs").combine_chunks().flatten().to_numpy()
        order = np.argsort(np.repeat(np.arange(len(size)), size) * width + ranks, kind="stable")
        ids = rows.column("id").combine_chunks()
        ids = ids.fill_null(last).to_numpy()
        return build_tree(ptr, ranks[order], tf[order], rows.column("m").to_numpy(), ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        weight = np.zeros(width, np.int64)
        for tree in trees(batches):
            for (_, term, w), found in zip(items, best, strict=True):
                weight[term] = w
                search(tree, weight, found)
                weight[term] = 0
        for (item, _, _), found in zip(items, best, strict=True):
            if len(found.id):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found.id), item)), pa.array(found.id), pa.array(found.score)], names=["item", "id", "score"])

    found = vectors.mapInArrow(run, "item long, id long, score long")
    return found.withColumn("id", F.when(F.col("id") != last, F.col("id")))


def _top(rows: DataFrame, groups: list[str], k: int) -> DataFrame:
    order = W.partitionBy(*groups).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _blocks(items: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The query items in blocks of about ``block_chars`` characters, one
    block at a time on the driver; a longer item is a block of its own."""
    block, size = [], 0
    for row in items.select(F.col(item_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator():
        block.append((row[0], terms_of(row[1])))
        size += len(row[1] or "")
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def _search_block(docs: DataFrame, block: list[tuple[int | None, list[bytes]]], k: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    terms = sorted({t for _, own in block for t in own})
    number = {t: i for i, t in enumerate(terms)}
    vectors = written(restricted(docs, Vocabulary(terms), id_col, text_col), "search-vectors")
    totals = vectors.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("l")).first()
    n, length = totals["n"], totals["l"] or 0
    df = np.zeros(len(terms), np.int64)
    for row in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most the block's terms
        df[row["t"]] = row["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    rank = np.empty(len(terms), np.int64)
    rank[np.lexsort((np.arange(len(terms)), -df))] = np.arange(len(terms))
    queries = []
    for i, (_, own) in enumerate(block):
        of, times = np.unique(np.array([number[t] for t in own], np.int64), return_counts=True)
        queries.append((i, rank[of], weight[of] * times))
    m = F.expr(f"100 - 25 + (cast(25 * n as decimal(19, 0)) * {n}BD) div {max(length, 1)}BD").cast("long")
    known = vectors.filter(F.size("terms") > 0).select("id", m.alias("m"), "terms", "tfs")
    found = _search_rows(known, rank, queries, max(len(terms), 1), k)
    local = written(found.withColumn("salt", F.spark_partition_id() % MERGE_SALTS), "search-found")
    merged = _top(_top(local, ["item", "salt"], k), ["item"], k)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "item long, item_id long")
    return merged.join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score", F.col("item").alias("item_row"))


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per item its ``k`` highest-scoring documents with a score above 0:
    (item_id, rank from 1, doc_id, score, item_row).

    Every row of ``items`` is an item of its own (``item_row`` tells rows of
    one id apart, within their block); items without terms find nothing.
    Items are worked in blocks of ``block_chars`` characters, each with one
    pass over ``docs``, so tasks and driver hold one block's terms only.
    Documents whose text is null or without terms never match. Rows of
    ``docs`` with a repeated id are documents of their own; equal scores are
    ranked by ascending id, null ids last. Other columns are ignored. Empty
    tables give no rows.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long, item_row long")
    for block in _blocks(items, item_col, item_text_col, block_chars):
        with scratch(spark):
            out = out.union(kept(_search_block(docs, block, k, id_col, text_col), "search-result"))
    return out
