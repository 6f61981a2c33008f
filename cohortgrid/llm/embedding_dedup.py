"""Near-duplicate vectors by random-hyperplane hashing in several tables,
with exact cosine verification and distributed connected components.

Equal vectors are folded first, so a vector that a third of all rows hold
is one weighted vector. A vector's sign pattern under a table's hyperplanes
is its bucket there; the number of hyperplanes follows the row count, and
the number of tables the recall wanted at the least cosine. A bucket over
the block size is compared in pairs of blocks, so no bucket is capped.
A pair that meets in several tables counts in the first of them only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgrid.llm.components import connected_components
from cohortgrid.llm.storage import kept, scratch, written

BUCKET_ROWS, BLOCK_ROWS = 256, 1024


def plan_tables(rows: int, cosine: float, recall: float) -> tuple[int, int]:
    """Hyperplanes a table, and tables: a pair at the least cosine agrees
    in one plane with probability 1 - angle / pi."""
    bits = min(30, max(4, math.ceil(math.log2(max(2, rows / BUCKET_ROWS)))))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def signatures(unit: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """Per vector and table the sign pattern under ``bits`` hyperplanes."""
    planes = np.random.default_rng([seed, unit.shape[1]]).standard_normal((unit.shape[1], tables * bits))
    signs = (unit @ planes > 0).reshape(len(unit), tables, bits)
    return (signs << np.arange(bits)).sum(axis=2).astype("<u4")


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, first by their largest
    component so that no square overflows."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _hash(bits: int, tables: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(dims) - dims
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                vectors = flat[starts[own][:, None] + np.arange(dim)]
                found = signatures(unit_rows(vectors), bits, tables, seed)
                n = len(own)
                yield pa.record_batch(
                    [
                        pa.array(batch.column(0).take(pa.array(own))),
                        pa.array(batch.column(2).take(pa.array(own))),
                        pa.array(np.full(n, dim, np.int32)),
                        pa.array([v.tobytes() for v in vectors.astype("<f8")], pa.binary()),
                        pa.array([s.tobytes() for s in found], pa.binary()),
                        pa.array(found.astype(np.int64).tolist(), pa.list_(pa.int64())),
                    ],
                    ["gid", "weight", "dim", "vector", "patterns", "buckets"],
                )

    return run


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the edges (i, j) over n nodes connect: each
    node with the least node it reaches."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            break
    at = np.flatnonzero(label != np.arange(n))
    return at, label[at]


def _compare(rows: list[dict], cosine: float) -> pa.RecordBatch | None:
    """One block pair of a bucket: per vector the weight of the vectors it
    is linked with here and in no earlier table, and connecting edges."""
    table = rows[0]["table"]
    gid = np.array([r["gid"] for r in rows], np.int64)
    weight = np.array([r["weight"] for r in rows], np.int64)
    side = np.array([r["side"] for r in rows])
    unit = unit_rows(np.frombuffer(b"".join(r["vector"] for r in rows), "<f8").reshape(len(rows), -1))
    patterns = np.frombuffer(b"".join(r["patterns"] for r in rows), "<u4").reshape(len(rows), -1)
    close = unit @ unit.T >= cosine
    # Within a block each pair once, across two blocks one row of each.
    close &= np.triu(np.ones_like(close), 1) if (side == 0).all() else side[:, None] < side[None, :]
    i, j = np.nonzero(close)
    if table and len(i):
        earlier = (patterns[i, :table] == patterns[j, :table]).any(axis=1)
        i, j = i[~earlier], j[~earlier]
    if not len(i):
        return None
    links = np.bincount(i, weight[j], len(rows)) + np.bincount(j, weight[i], len(rows))
    at = np.flatnonzero(links)
    a, b = _forest(len(rows), i, j)
    none = [None] * len(a)
    return pa.record_batch(
        [pa.array([*gid[at].tolist(), *none], pa.int64()), pa.array([*links[at].astype(np.int64).tolist(), *none], pa.int64()), pa.array([*[None] * len(at), *gid[a].tolist()], pa.int64()), pa.array([*[None] * len(at), *gid[b].tolist()], pa.int64())],
        ["gid", "links", "a", "b"],
    )


def _verify(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                own = (row["dim"], row["table"], row["bucket"], row["left"], row["right"])
                if own != key:
                    if len(rows) > 1 and (out := _compare(rows, cosine)):
                        yield out
                    key, rows = own, []
                rows.append(row)
        if len(rows) > 1 and (out := _compare(rows, cosine)):
            yield out

    return run


def _dedup(vectors: DataFrame, cosine: float, recall: float, seed: int, id_col: str, vector_col: str) -> DataFrame:
    narrow = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = narrow.withColumn("usable", usable)
    groups = rows.filter("usable").groupBy("vector").agg(F.min("id").alias("least"), F.count("*").alias("weight"))
    groups = written(groups.withColumn("gid", F.monotonically_increasing_id()), "embedding-groups")
    bits, tables = plan_tables(groups.count(), cosine, recall)
    hashed = groups.select("gid", "vector", "weight").mapInArrow(_hash(bits, tables, seed), "gid long, weight long, dim int, vector binary, patterns binary, buckets array<long>")
    hashed = written(hashed, "embedding-hashed")

    keys = ["dim", "table", "bucket"]
    counts = hashed.select("dim", F.posexplode("buckets").alias("table", "bucket")).groupBy(*keys).agg(F.count("*").alias("rows")).filter(f"rows > {BLOCK_ROWS}")
    counts = counts.select(*keys, F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks"))
    placed = hashed.select("gid", "weight", "dim", "vector", "patterns", F.posexplode("buckets").alias("table", "bucket"))
    if counts.isEmpty():
        dealt = placed.select(*placed.columns, F.lit(0).alias("left"), F.lit(0).alias("right"), F.lit(0).alias("side"))
    else:
        dealt = placed.join(written(counts, "embedding-blocks"), keys, "left").fillna(1, ["blocks"])
        dealt = dealt.withColumn("own", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other")).withColumn("side", (F.col("own") > F.col("other")).cast("int"))
    block = [*keys, "left", "right"]
    work = dealt.select(*block, "side", "gid", "weight", "vector", "patterns").repartition(*block).sortWithinPartitions(*block, "gid")
    found = written(work.mapInArrow(_verify(cosine), "gid long, links long, a long, b long"), "embedding-links")

    links = found.filter(F.col("gid").isNotNull()).groupBy("gid").agg(F.sum("links").alias("links"))
    components = connected_components(found.filter(F.col("a").isNotNull()), "a", "b", "embedding-components")
    label = groups.select("gid", "vector", "least", "weight").join(links, "gid", "left").join(components.withColumnRenamed("node", "gid"), "gid", "left")
    label = written(label.withColumn("component", F.coalesce("component", "gid")), "embedding-labels")
    named = label.groupBy("component").agg(F.min("least").alias("component_id"))
    verdict = written(label.join(named, "component").select("vector", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "embedding-verdict")

    out = rows.join(verdict.withColumn("usable", F.lit(True)), ["usable", "vector"], "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def embedding_dedup(vectors: DataFrame, cosine: float = 0.9, recall: float = 0.999, seed: int = 42, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per input row: (id, n_links, component_id, kept).

    Two rows link when the cosine of their vectors, in double precision,
    is at least ``cosine``; no pair below it is linked, and a pair at it is
    found with probability ``recall``. ``n_links`` counts other rows linked
    directly, equal vectors included; ``component_id`` is the smallest id
    reachable by links, itself included; ``kept`` marks rows whose id is
    that. Vectors that are null, empty or zero or hold null or non-finite
    components link with nothing, and vectors of different length never
    link. A null id is larger than any other; repeated rows link with each
    other. Other columns are ignored; an empty table gives no rows.
    """
    with scratch(vectors.sparkSession):
        return kept(_dedup(vectors, cosine, recall, seed, id_col, vector_col), "embedding-result")
