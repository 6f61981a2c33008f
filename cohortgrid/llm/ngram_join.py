"""Jaccard join on word n-grams with several global token orders.

1. A pass over the texts hashes each document's shingles. Postings go out
   in packed blocks by hash bucket; each bucket counts its tokens' document
   frequencies and answers only for tokens of two or more documents.
2. A document whose shared tokens are fewer than the overlap that a link
   needs is out. The others order their tokens by frequency, and by
   frequency class with different hashes; under each order a linked pair
   shares a token of its prefixes.
3. Documents joined by prefix tokens of the first order form candidate
   clusters. In a cluster a pair is verified only if it also shares prefix
   tokens under every other order and its sizes allow a link.

Equal shingle sets are folded first, weighted by their rows. Clusters over
the block size are compared in pairs of blocks, every pair of documents
once; only counts of links and connecting edges leave a task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgrid.llm.arrays import LOWER, mix, row_slices, span_hashes, utf8, words
from cohortgrid.llm.components import connected_components
from cohortgrid.llm.embedding_dedup import _forest
from cohortgrid.llm.storage import kept, scratch, written

CHUNK_TOKENS, CHUNK_DOCS = 1 << 21, 60_000
BUCKET_TOKENS = 1 << 20
FREQUENT = 64
BLOCK_DOCS, BLOCK_TOKENS = 1024, 1 << 21
DENSE_SHARE, DENSE_TOKENS, SPARSE_PAIRS = 64, 1024, 1 << 19
ORDER_SEEDS = (0x51ED270B, 0xC2B2AE35)

_FLOW = "key long, kind int, chunk long, a binary, b binary, c binary"
_POSTINGS, _COUNTS, _DIRECTORY = 0, 1, 2


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its word n-grams; a row of
    fewer words has one, of its whole sequence, and one without words none."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    word = span_hashes(data, starts, ends)
    grams = np.zeros(max(0, len(word) - n + 1), np.uint64)
    for k in range(n):
        grams += word[k : k + len(grams)] * np.uint64(pow(0x9E3779B97F4A7C15 | 1, k + 1, 1 << 64))
    grams = mix(grams)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= n:
            out.append(np.unique(grams[lo : hi - n + 1]))
        elif hi > lo:
            weights = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(hi - lo)], np.uint64)
            out.append(mix(np.array([(word[lo:hi] * weights).sum(dtype=np.uint64)]) + np.uint64(hi - lo)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _flow_batch(rows: list[tuple]) -> pa.RecordBatch:
    key, kind, chunk, a, b, c = zip(*rows, strict=True)
    return pa.record_batch([pa.array(key, pa.int64()), pa.array(kind, pa.int32()), pa.array(chunk, pa.int64()), *(pa.array(x, pa.binary()) for x in (a, b, c))], ["key", "kind", "chunk", "a", "b", "c"])


def _chunk_rows(chunk: int, ids: list, sets: list[np.ndarray], sums: list[bytes], bucket_bits: int) -> list[tuple]:
    """A chunk's postings by bucket, and its directory. Documents with the
    same set as an earlier one of the chunk point to it and post nothing.
    Tokens of FREQUENT or more documents of the chunk post one count; their
    documents stay in the directory."""
    seen: dict[bytes, int] = {}
    rep = np.arange(len(sets), dtype=np.uint32)
    for k, s in enumerate(sets):
        if len(s):
            rep[k] = seen.setdefault(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), k)
    own = np.flatnonzero(rep == np.arange(len(sets)))
    sizes = np.fromiter(map(len, sets), np.uint32, len(sets))
    tokens = np.concatenate([np.zeros(0, np.uint64), *(sets[k] for k in own)])
    doc = np.repeat(own, sizes[own]).astype("<u2")
    order = np.argsort(tokens, kind="stable")
    tokens, doc = tokens[order], doc[order]
    rows = []
    if len(tokens):
        heads = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        counts = np.diff(np.r_[heads, len(tokens)])
        often = counts >= FREQUENT
        common = np.repeat(often, counts)
        frequent, n_frequent = tokens[heads[often]], counts[often]
        hot_tokens, hot_doc = tokens[common], doc[common]
        tokens, doc = tokens[~common], doc[~common]
        shift = np.uint64(64 - bucket_bits)
        for values, other, kind in ((tokens, doc, _POSTINGS), (frequent, n_frequent.astype("<u4"), _COUNTS)):
            bucket = values >> shift
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]).tolist() if len(values) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(values)], strict=False):
                # The top byte follows from the bucket.
                packed = np.ascontiguousarray(values[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()
                rows.append((int(bucket[lo]), kind, chunk, packed, other[lo:hi].tobytes(), None))
    else:
        hot_tokens, hot_doc = tokens, doc
    directory = np.array([0 if i is None else i for i in ids], "<i8").tobytes() + np.array([i is None for i in ids], np.uint8).tobytes() + b"".join(sums)
    rows.append((-1 - chunk, _DIRECTORY, chunk, directory, sizes.astype("<u4").tobytes() + rep.astype("<u4").tobytes(), hot_tokens.astype("<u8").tobytes() + hot_doc.tobytes()))
    return rows


def _post(n: int, bucket_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        ids: list = []
        sets: list[np.ndarray] = []
        sums: list[bytes] = []
        held = 0
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            all_ids = batch.column(0).to_pylist()
            for lo, hi in row_slices(offsets):
                found = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], n)
                for k, one in enumerate(found, lo):
                    ids.append(all_ids[k])
                    sets.append(one)
                    sums.append(hashlib.sha256(data[offsets[k] : offsets[k + 1]]).digest())
                    held += len(one)
                    if held >= CHUNK_TOKENS or len(ids) >= CHUNK_DOCS:
                        yield _flow_batch(_chunk_rows(chunk, ids, sets, sums, bucket_bits))
                        chunk, ids, sets, sums, held = chunk + 1, [], [], [], 0
        if ids:
            yield _flow_batch(_chunk_rows(chunk, ids, sets, sums, bucket_bits))

    return run


def _by_key(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows with equal keys in a sorted partition."""
    current, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != current:
                if rows:
                    yield current, rows
                current, rows = key, []
            rows.append(row)
    if rows:
        yield current, rows


def _frequencies(bucket_bits: int):
    """Of one bucket: frequencies of its tokens, sent back to each chunk
    for tokens of two or more documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key,), rows in _by_key(batches, "key"):
            if key < 0:
                yield _flow_batch([(r["key"], r["kind"], r["chunk"], r["a"], r["b"], r["c"]) for r in rows])
                continue
            top = np.uint64(key >> (bucket_bits - 8))
            parts, weights, others = [], [], []
            for r in rows:
                wide = np.zeros((len(r["a"]) // 7, 8), np.uint8)
                wide[:, :7] = np.frombuffer(r["a"], np.uint8).reshape(-1, 7)
                parts.append(wide.view("<u8").ravel() | (top << np.uint64(56)))
                others.append(np.frombuffer(r["b"], "<u2" if r["kind"] == _POSTINGS else "<u4"))
                weights.append(np.ones(len(wide), np.int64) if r["kind"] == _POSTINGS else others[-1].astype(np.int64))
            tokens, weight = np.concatenate(parts), np.concatenate(weights)
            order = np.argsort(tokens, kind="stable")
            heads = np.flatnonzero(np.r_[True, tokens[order][1:] != tokens[order][:-1]])
            total = np.add.reduceat(weight[order], heads)
            frequency = np.empty(len(tokens), np.int64)
            frequency[order] = np.repeat(total, np.diff(np.r_[heads, len(tokens)]))
            at, out = 0, []
            for r, part, other in zip(rows, parts, others, strict=True):
                own = frequency[at : at + len(part)]
                at += len(part)
                shared = own > 1
                if shared.any():
                    out.append((key, r["kind"], r["chunk"], part[shared].tobytes(), np.minimum(own[shared], 2**32 - 1).astype("<u4").tobytes(), other[shared].tobytes() if r["kind"] == _POSTINGS else None))
            if out:
                yield _flow_batch(out)

    return run


def prefixes(tokens: np.ndarray, frequency: np.ndarray, length: int) -> list[np.ndarray]:
    """The least ``length`` tokens under each global order: by frequency,
    then by frequency class and a hash of each seed."""
    out = [tokens[np.lexsort((tokens, frequency))[:length]]]
    level = np.frexp(frequency.astype(np.float64))[1]
    for seed in ORDER_SEEDS:
        out.append(tokens[np.lexsort((mix(tokens ^ np.uint64(seed)), level))[:length]])
    return out


_SURVEY = "uid long, id long, n long, rep long, sha256 binary, shared binary, prefix array<long>, others binary, digest binary"


def _survey(percent: int):
    """Per document of a chunk: its set size, and for those that can still
    have a link the shared tokens and the prefixes; where all tokens are
    shared, so that other chunks may hold the same set, also its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (chunk,), rows in _by_key(batches, "chunk"):
            directory = next(r for r in rows if r["kind"] == _DIRECTORY)
            n_docs = len(directory["a"]) // 41
            ids = np.frombuffer(directory["a"], "<i8", n_docs)
            no_id = np.frombuffer(directory["a"], np.uint8, n_docs, 8 * n_docs).astype(bool)
            sums = directory["a"][9 * n_docs :]
            sizes, rep = np.frombuffer(directory["b"], "<u4").astype(np.int64).reshape(2, n_docs)
            hot_n = len(directory["c"]) // 10
            hot_tokens = np.frombuffer(directory["c"], "<u8", hot_n)
            hot_doc = np.frombuffer(directory["c"], "<u2", offset=8 * hot_n)
            tokens, frequency, doc = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.uint16)]
            counted = {_POSTINGS: [], _COUNTS: [np.zeros((2, 0), np.uint64)]}
            for r in rows:
                if r["kind"] == _POSTINGS:
                    tokens.append(np.frombuffer(r["a"], "<u8"))
                    frequency.append(np.frombuffer(r["b"], "<u4"))
                    doc.append(np.frombuffer(r["c"], "<u2"))
                elif r["kind"] == _COUNTS:
                    counted[_COUNTS].append(np.stack([np.frombuffer(r["a"], "<u8"), np.frombuffer(r["b"], "<u4").astype(np.uint64)]))
            if hot_n:
                known, total = np.concatenate(counted[_COUNTS], axis=1)
                order = np.argsort(known)
                tokens.append(hot_tokens)
                frequency.append(total[order][np.searchsorted(known[order], hot_tokens)].astype(np.uint32))
                doc.append(hot_doc)
            token, often, owner = np.concatenate(tokens), np.concatenate(frequency), np.concatenate(doc)
            order = np.argsort(owner, kind="stable")
            token, often = token[order], often[order]
            ends = np.searchsorted(owner[order], np.arange(n_docs), "right")
            out: list[list] = [[] for _ in range(9)]
            for k in range(n_docs):
                lo, hi = (ends[k - 1] if k else 0), ends[k]
                need = -(-percent * int(sizes[k]) // 100)
                alive = rep[k] == k and sizes[k] and hi - lo >= need
                kept = prefixes(token[lo:hi], often[lo:hi], int(hi - lo) - need + 1) if alive else None
                digest = hashlib.blake2b(np.sort(token[lo:hi]).tobytes(), digest_size=16).digest() if alive and hi - lo == sizes[k] else None
                row = (chunk << 16 | k, None if no_id[k] else int(ids[k]), int(sizes[k]), chunk << 16 | int(rep[k]), sums[32 * k : 32 * k + 32], token[lo:hi].tobytes() if alive else None, kept[0].view(np.int64).tolist() if alive else None, b"".join(p.tobytes() for p in kept[1:]) if alive else None, digest)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["uid", "id", "n", "rep", "sha256", "shared", "prefix", "others", "digest"])

    return run


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _by_token(rows: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The distinct tokens of some sets, where each starts and in how many
    rows it is, and the rows on end."""
    tokens = np.concatenate(rows)
    order = np.argsort(tokens, kind="stable")
    return *np.unique(tokens[order], return_index=True, return_counts=True), np.repeat(np.arange(len(rows)), [len(r) for r in rows])[order]


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of ``left`` has in common with each of
    ``right``: tokens of many rows by matrix products, others by pairs."""
    out = np.zeros((len(left), len(right)), np.int64)
    known, start, size, row = _by_token(left)
    known_r, start_r, size_r, row_r = _by_token(right)
    _, at, at_r = np.intersect1d(known, known_r, assume_unique=True, return_indices=True)
    start, size, start_r, size_r = start[at], size[at], start_r[at_r], size_r[at_r]
    pairs = size * size_r
    dense = np.flatnonzero(pairs * DENSE_SHARE >= out.size)
    for lo in range(0, len(dense), DENSE_TOKENS):
        own = dense[lo : lo + DENSE_TOKENS]
        x, y = (np.zeros((n, len(own)), np.float32) for n in out.shape)
        x[row[_ranges(start[own], size[own])], np.repeat(np.arange(len(own)), size[own])] = 1
        y[row_r[_ranges(start_r[own], size_r[own])], np.repeat(np.arange(len(own)), size_r[own])] = 1
        out += (x @ y.T).astype(np.int64)
    sparse = np.flatnonzero(pairs * DENSE_SHARE < out.size)
    for own in np.split(sparse, np.flatnonzero(np.diff(np.cumsum(pairs[sparse]) // SPARSE_PAIRS)) + 1):
        if len(own):
            k = _ranges(np.zeros(len(own), np.int64), pairs[own])
            wide = np.repeat(size_r[own], pairs[own])
            i = row[np.repeat(start[own], pairs[own]) + k // wide]
            j = row_r[np.repeat(start_r[own], pairs[own]) + k % wide]
            out += np.bincount(i * len(right) + j, minlength=out.size).reshape(out.shape)
    return out


def _compare(rows: list[dict], percent: int) -> pa.RecordBatch | None:
    """One pair of blocks: per document the weight of the documents that it
    is linked with here, and connecting edges."""
    within = rows[0]["left"] == rows[0]["right"]
    side = np.array([r["side"] for r in rows])
    own, other = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if within else 1))
    if not len(own) or not len(other):
        return None
    n = np.array([r["n"] for r in rows], np.int64)
    close = 100 * np.minimum.outer(n[own], n[other]) >= percent * np.maximum.outer(n[own], n[other])
    if within:  # each pair once
        close &= np.triu(np.ones_like(close), 1)
    for order in range(len(ORDER_SEEDS)):
        some, some_other = np.flatnonzero(close.any(axis=1)), np.flatnonzero(close.any(axis=0))
        own, other, close = own[some], other[some_other], close[np.ix_(some, some_other)]
        if not len(own):
            return None
        first = [np.frombuffer(r["others"], np.uint64).reshape(len(ORDER_SEEDS), -1)[order] for r in rows]
        close &= common_counts([first[k] for k in own], [first[k] for k in other]) > 0
    some, some_other = np.flatnonzero(close.any(axis=1)), np.flatnonzero(close.any(axis=0))
    own, other, close = own[some], other[some_other], close[np.ix_(some, some_other)]
    if not len(own):
        return None
    shared = [np.frombuffer(r["shared"], np.uint64) for r in rows]
    common = common_counts([shared[k] for k in own], [shared[k] for k in other])
    i, j = np.nonzero(close & (100 * common >= percent * (np.add.outer(n[own], n[other]) - common)))
    if not len(i):
        return None
    i, j = own[i], other[j]
    uid, weight = (np.array([r[c] for r in rows], np.int64) for c in ("uid", "weight"))
    links = np.zeros(len(rows), np.int64)
    np.add.at(links, i, weight[j])
    np.add.at(links, j, weight[i])
    at = np.flatnonzero(links)
    a, b = _forest(len(rows), i, j)
    none, gone = [None] * len(a), [None] * len(at)
    return pa.record_batch([pa.array(x, pa.int64()) for x in ([*uid[at].tolist(), *none], [*links[at].tolist(), *none], [*gone, *uid[a].tolist()], [*gone, *uid[b].tolist()])], ["uid", "links", "a", "b"])


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_key(batches, "cluster", "left", "right"):
            if len(rows) > 1 and (out := _compare(rows, percent)):
                yield out

    return run


def _numbered(df: DataFrame, n_blocks: str) -> F.Column:
    return F.pmod(F.xxhash64("uid"), F.col(n_blocks))


def _links(live: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows (uid, links) of the documents' links by pair of blocks, and
    edges (a, b) that connect what links connect; ``sets`` (gid, weight)
    names one document of each distinct set."""
    posts = written(live.select("uid", F.explode("prefix").alias("token")), "ngram-prefix")
    groups = written(posts.groupBy("token").agg(F.min("uid").alias("first"), F.count("*").alias("docs")).filter("docs > 1").select("token", "first"), "ngram-tokens")
    clusters = connected_components(posts.join(groups, "token").select("uid", "first").distinct(), "uid", "first", "ngram-clusters")
    single = clusters.select(F.col("node").alias("uid"), F.col("component").alias("cluster")).join(sets.select(F.col("gid").alias("uid"), "weight"), "uid")
    placed = written(single.join(live.select("uid", "n", "shared", "others"), "uid"), "ngram-placed")
    by_docs, by_tokens = F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum(F.length("shared")) / (8 * BLOCK_TOKENS))
    blocks = written(placed.groupBy("cluster").agg(F.count("*").alias("docs"), F.greatest(by_docs, by_tokens).cast("long").alias("n_blocks")).filter("docs > 1").select("cluster", "n_blocks"), "ngram-blocks")
    dealt = placed.join(blocks, "cluster").withColumn("own", _numbered(placed, "n_blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    dealt = dealt.withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other")).withColumn("side", (F.col("own") > F.col("other")).cast("int"))
    block = ["cluster", "left", "right"]
    work = dealt.select(*block, "side", "uid", "weight", "n", "shared", "others").repartition(*block).sortWithinPartitions(*block, "uid")
    return written(work.mapInArrow(_verify(percent), "uid long, links long, a long, b long"), "ngram-links")


def _join(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # A shingle has about a word of its own: some six bytes of text.
    volume = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(22, max(8, math.ceil(math.log2(max(1, volume / 6 / BUCKET_TOKENS)))))
    flow = narrow.mapInArrow(_post(n, bits), _FLOW).repartition("key").sortWithinPartitions("key")
    back = flow.mapInArrow(_frequencies(bits), _FLOW).repartition("chunk").sortWithinPartitions("chunk")
    survey = written(back.mapInArrow(_survey(percent), _SURVEY), "ngram-survey")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("uid"))).alias("first")
    per_rep = written(survey.groupBy("rep").agg(first, F.count("*").alias("weight"), F.min("digest").alias("digest")), "ngram-reps")
    # Equal sets of several chunks. A document without a digest is alone, and
    # stays out of the join, where all nulls would meet in one task.
    copies, alone = per_rep.filter(F.col("digest").isNotNull()), per_rep.filter(F.col("digest").isNull())
    equal = copies.join(copies.groupBy("digest").agg(F.min("rep").alias("gid")), "digest").select("rep", "gid", "first", "weight")
    of_rep = written(equal.union(alone.select("rep", F.col("rep").alias("gid"), "first", "weight")), "ngram-equal")
    sets = written(of_rep.groupBy("gid").agg(F.min("first").alias("first"), F.sum("weight").alias("weight")), "ngram-sets")

    live = survey.filter(F.col("shared").isNotNull()).select("uid", "n", "shared", "prefix", "others")
    found = _links(live, sets, percent)
    links = found.filter(F.col("uid").isNotNull()).groupBy(F.col("uid").alias("gid")).agg(F.sum("links").alias("links"))
    components = connected_components(found.filter(F.col("a").isNotNull()), "a", "b", "ngram-components")

    label = sets.join(links, "gid", "left").join(components.withColumnRenamed("node", "gid"), "gid", "left")
    label = label.select("gid", "first", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "gid").alias("component"))
    label = written(label, "ngram-labels")
    named = written(label.groupBy("component").agg(F.min("first").alias("first")), "ngram-names")
    named_sets = label.select("gid", "n_links", "component").join(named, "component").select("gid", "n_links", "first")
    verdict = written(of_rep.select("rep", "gid").join(named_sets, "gid").select("rep", "n_links", "first"), "ngram-verdict")
    out = survey.select("uid", "id", "n", "rep", "sha256").join(verdict, "rep")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("first.id").alias("component_id"), (F.col("uid") == F.col("first.uid")).alias("kept"), F.lower(F.hex("sha256")).alias("text_sha256"), "n_links")


def ngram_jaccard_join(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, n_shingles, component_id, kept,
    text_sha256, n_links); ``kept`` marks one row of each component, that of the
    smallest id, and the digest of its text tells rows of an id apart.

    Words are runs of other than ASCII white space, A-Z lower-cased. Two
    documents link when 100 * common >= percent * union of their sets of
    distinct word n-grams (64-bit hashes); ``component_id`` is the smallest
    id reachable by links; ``n_links`` counts other rows linked directly,
    equal ones included. A text of fewer than n words has one shingle; a
    null text or one without words has none and links with nothing, so its
    component is its own id. A null id is larger than any other; repeated
    rows link like other copies. Other columns are ignored, an empty table
    gives no rows.
    """
    with scratch(docs.sparkSession):
        return kept(_join(docs, n, percent, id_col, text_col), "ngram-result")
