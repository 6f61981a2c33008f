"""Exact deduplication by Grace hashing.

Records are partitioned by the leading bits of their digest into bucket
tables in the shared folder; a bucket whose distinct content does not fit
is partitioned again by its next bits. Then one open-addressing table per
bucket compares complete contents.

Copies inside one input split are folded before anything is shuffled, so
a text that makes up a third of all rows travels about once per split;
the copies follow as narrow (row, representative) pairs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgrid.llm.storage import kept, scratch, written

_TO_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_SPACES = re.compile(rb"  +")

RECORDS = "uid long, id long, rep long, digest binary, bytes long, content binary"


def normalise(text: bytes) -> bytes:
    """Each run of ASCII white space becomes one space (no trimming)."""
    return _SPACES.sub(b" ", text.translate(_TO_SPACE))


class ContentTable:
    """Open addressing with linear probing; equal means equal bytes."""

    def __init__(self) -> None:
        self.slots: list[int] = [-1] * 1024
        self.digests: list[bytes] = []
        self.contents: list[bytes] = []
        self.owners: list[int] = []
        self.bytes = 0

    def owner(self, digest: bytes, content: bytes, uid: int) -> int:
        """The first row seen with this content; ``uid`` if there is none."""
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (k := self.slots[at]) >= 0:
            if self.digests[k] == digest and self.contents[k] == content:
                return self.owners[k]
            at = (at + 1) & mask
        self.slots[at] = len(self.contents)
        self.digests.append(digest)
        self.contents.append(content)
        self.owners.append(uid)
        self.bytes += len(content)
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return uid

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for k, digest in enumerate(self.digests):
            at = int.from_bytes(digest[-8:], "little") & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k


def _fold(table_bytes: int):
    """Per split: normalise, digest, and point copies at the split's first
    row with the same content. The table is emptied at ``table_bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 36
        seen = ContentTable()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            uids, reps, digests, sizes, contents = [], [], [], [], []
            for text in texts:
                content = normalise(text or b"")
                digest = hashlib.sha256(content).digest()
                rep = seen.owner(digest, content, uid)
                uids.append(uid)
                reps.append(rep)
                digests.append(digest)
                sizes.append(len(content))
                contents.append(content if rep == uid else None)
                uid += 1
                if seen.bytes > table_bytes:
                    seen = ContentTable()
            yield pa.record_batch(
                [pa.array(uids, pa.int64()), pa.array(ids, pa.int64()), pa.array(reps, pa.int64()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(contents, pa.binary())],
                ["uid", "id", "rep", "digest", "bytes", "content"],
            )

    return run


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come bucket by bucket; each bucket has a table of its own."""
    bucket, seen = None, ContentTable()
    for batch in batches:
        own = []
        for key, uid, digest, content in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if key != bucket:
                bucket, seen = key, ContentTable()
            own.append(seen.owner(digest, content, uid))
        yield pa.record_batch([batch.column(1), pa.array(own, pa.int64())], ["rep", "class"])


def _bits(digest, level: int):
    """Bits of the bucket key at a level: 8 bits of the digest a level."""
    return F.conv(F.hex(F.substring(digest, level + 1, 1)), 16, 10).cast("long")


def spill_buckets(records: DataFrame, bucket_bytes: int, max_level: int = 16) -> DataFrame:
    """Bucket every record (digest, bytes, ...), splitting a bucket by its
    digest's next byte as long as its distinct content is over
    ``bucket_bytes``. Each level is a written table; only records of
    buckets that were too large move on. ``max_level`` bytes of a SHA-256
    tell any two buckets apart that could still be split."""
    pending = records.withColumn("bucket", F.hex(F.substring("digest", 1, 1)))
    fitting: list[DataFrame] = []
    for level in range(1, max_level):
        per_text = pending.groupBy("bucket", "digest").agg(F.max("bytes").alias("bytes"))
        over = per_text.groupBy("bucket").agg(F.sum("bytes").alias("total"), F.count("*").alias("texts")).filter((F.col("total") > bucket_bytes) & (F.col("texts") > 1)).select("bucket")
        if over.isEmpty():
            break
        fitting.append(pending.join(over, "bucket", "left_anti"))
        deeper = pending.join(over, "bucket", "left_semi").withColumn("bucket", F.hex(F.substring("digest", 1, level + 1)))
        pending = written(deeper, f"exact-spill-{level}")
    for part in fitting:
        pending = pending.unionByName(part)
    return pending


def _dedup(docs: DataFrame, id_col: str, text_col: str, bucket_bytes: int, table_bytes: int) -> DataFrame:
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    records = written(narrow.mapInArrow(_fold(table_bytes), RECORDS), "exact-records")

    reps = records.filter(F.col("content").isNotNull()).select("uid", "digest", "bytes", "content")
    bucketed = spill_buckets(reps, bucket_bytes).select("bucket", "uid", "digest", "content")
    classes = written(bucketed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_probe, "rep long, class long"), "exact-classes")

    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("uid"))
    per_rep = records.groupBy("rep").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
    per_class = classes.join(per_rep, "rep").groupBy("class").agg(F.min("first").alias("first"), F.sum("n").alias("group_size"))
    verdict = classes.join(per_class, "class").select("rep", "first", "group_size")
    out = records.select("uid", "id", "rep", "digest").join(verdict, "rep")
    return out.select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.col("first.uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 64 << 20, table_bytes: int = 32 << 20) -> DataFrame:
    """One row per input row: (id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical after white-space folding. Of equal
    texts the row with the smallest id stays; a null id counts as larger
    than any other, and of rows with the same id exactly one stays. A null
    text is empty, and empty texts form a group like any other. Other
    columns are ignored, an empty table gives no rows.
    """
    with scratch(docs.sparkSession):
        return kept(_dedup(docs, id_col, text_col, bucket_bytes, table_bytes), "exact-result")
