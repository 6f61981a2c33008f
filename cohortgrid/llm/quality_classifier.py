"""Quality classifier by co-training.

Two views of a document, its text's content and its page metadata, each
get a logistic classifier. Over rounds each view labels the unlabelled
documents that it is most sure of for the other view's training set. Both
views' logits are then calibrated together on labelled rows that no view
was trained on, and all documents are scored.

The views are fitted on the driver to at most ``max_labelled`` labelled
rows (by a hash of the id, one row of each id) and the rows passed on, at
most ``per_round`` of either label in a round. What is passed on are the
surest of all unlabelled rows: features of every row are written once, and
each round scores that table and takes its top rows on Spark. Means and
spreads of the text features are an aggregate over all rows. Scoring covers
every row in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortgrid.llm.arrays import row_slices, span_hashes, utf8, words
from cohortgrid.llm.logistic import fit, fit_values, labelled_sample, one_per_id, predict, sigmoid
from cohortgrid.llm.storage import scratch, written

_BYTES = np.arange(256)
_CLASSES = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "letter": ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "stop": np.isin(_BYTES, list(b".,;:?")),
    "bang": _BYTES == ord("!"),
    "bar": _BYTES == ord("|"),
    "symbol": np.isin(_BYTES, list(b"#$%&*@^~_=+<>/\\{}[]")),
    "line": _BYTES == 10,
    "space": np.isin(_BYTES, list(b" \t\r")),
    "wide": _BYTES >= 128,
}
TEXT_FEATURES = [*(f"share_{c}" for c in _CLASSES), "log_words", "word_length", "distinct", "repeated", "short", "long", "empty"]


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of TEXT_FEATURES per document; all 0 but ``empty`` for one
    without words."""
    n, sizes = len(offsets) - 1, np.maximum(1, np.diff(offsets))
    out = np.zeros((n, len(TEXT_FEATURES)))
    for k, table in enumerate(_CLASSES.values()):
        running = np.r_[0, np.cumsum(table[data])]
        out[:, k] = (running[offsets[1:]] - running[offsets[:-1]]) / sizes
    starts, ends, first = words(data, offsets)
    count = np.diff(first)
    some = np.maximum(1, count)
    doc = np.repeat(np.arange(n), count)
    length = ends - starts
    hashes = span_hashes(data, starts, ends)
    same = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((hashes, doc))
    new = np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])] if len(hashes) else np.zeros(0, bool)
    k = len(_CLASSES)
    out[:, k] = np.log1p(count)
    out[:, k + 1] = np.bincount(doc, length, n) / some
    # Distinct words of a longer text are fewer: compare on the scale of logarithms.
    out[:, k + 2] = np.log1p(np.bincount(doc[order], new, n)) / np.maximum(1e-9, np.log1p(count))
    out[:, k + 3] = np.bincount(doc[1:], same, n) / some if len(doc) > 1 else 0
    out[:, k + 4] = np.bincount(doc, length <= 2, n) / some
    out[:, k + 5] = np.bincount(doc, length >= 15, n) / some
    out[:, k + 6] = count == 0
    return out


def metadata_values(columns: list[list]) -> np.ndarray:
    """A 64-bit number for each metadata value, nulls being a value too;
    numbers by their power of two."""
    out = np.zeros((len(columns[0]), len(columns)), np.int64)
    for k, column in enumerate(columns):
        known: dict = {}
        for row, value in enumerate(column):
            if value not in known:
                text = f"{k}:{int(np.log2(abs(value) + 1))}" if isinstance(value, (int, float)) and value == value else f"{k}:{value}"
                known[value] = np.uint64(xxhash.xxh64_intdigest(text, 1)).astype(np.int64)
            out[row, k] = known[value]
    return out


@dataclass
class ValueModel:
    """Weights of the metadata values met in training; others weigh nothing."""

    values: np.ndarray
    weights: np.ndarray  # one more for no known value, and the intercept

    @staticmethod
    def fitted(values: np.ndarray, label: np.ndarray) -> ValueModel:
        known, at = np.unique(values, return_inverse=True)
        b = fit_values(at.reshape(values.shape), label, len(known))
        return ValueModel(known, np.r_[b[:-1], 0.0, b[-1]])

    def logits(self, values: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.values, values)
        if len(self.values):
            near = np.minimum(at, len(self.values) - 1)
            at = np.where(self.values[near] == values, near, len(self.values))
        return self.weights[at].sum(axis=1) + self.weights[-1]


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    text: np.ndarray
    meta: ValueModel
    joint: np.ndarray
    threshold: float

    def views(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logits of either view."""
        return predict(self.text, (text - self.center) / self.scale), self.meta.logits(meta)

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.views(text, meta)
        return sigmoid(a), sigmoid(b), sigmoid(predict(self.joint, np.c_[a, b]))


#: What a view passes on: (the other view's number, keys, text features,
#: metadata values, label) of rows that it is sure of.
Passed = tuple[int, np.ndarray, np.ndarray, np.ndarray, int]


def co_train(text: np.ndarray, meta: np.ndarray, label: np.ndarray, fold: np.ndarray, center: np.ndarray, scale: np.ndarray, surest: Callable[[Model, list[np.ndarray]], list[Passed]], rounds: int, threshold: float) -> Model:
    """``label`` is 0 or 1; rows with ``fold`` 0 are kept for calibration.
    ``surest`` gives the rows that each view passes on, but for those that
    the other view was given before (their keys)."""
    train, held = fold != 0, fold == 0
    rows = [[(text[train], meta[train], label[train])] for _ in range(2)]
    keys = [np.zeros(0, np.int64) for _ in range(2)]

    def fitted() -> Model:
        (t, _, y), (_, m, z) = ([np.concatenate(c) for c in zip(*own, strict=True)] for own in rows)
        return Model(center, scale, fit((t - center) / scale, y), ValueModel.fitted(m, z), np.zeros(3), threshold)

    model = fitted()
    for _ in range(rounds):
        passed = surest(model, keys)
        if not any(len(k) for _, k, _, _, _ in passed):
            break
        for other, k, t, m, value in passed:
            rows[other].append((t, m, np.full(len(k), value)))
            keys[other] = np.union1d(keys[other], k)
        model = fitted()
    logits = np.c_[model.views(text, meta)]
    # The text view alone is the prior of the combination.
    model.joint = fit(logits[held], label[held], prior=np.array([1.0, 0.0, 0.0]))
    return model


def _sure_rows(batch: pa.RecordBatch, model: Model, given: list[np.ndarray], sure: float, per_round: int) -> pa.RecordBatch:
    """Of a batch (key, text, meta) the surest rows for either other view and
    label, not given to it before."""
    key = batch.column(0).to_numpy()
    text = batch.column(1).flatten().to_numpy().reshape(len(key), -1)
    meta = batch.column(2).flatten().to_numpy().reshape(len(key), -1)
    at, others, labels, surenesses = [], [], [], []
    for other, logits in zip((1, 0), model.views(text, meta), strict=True):
        free = ~np.isin(key, given[other])
        for value, confidence in ((1, sigmoid(logits)), (0, 1 - sigmoid(logits))):
            found = np.flatnonzero(free & (confidence >= sure))
            found = found[np.lexsort((key[found], -confidence[found]))[:per_round]]
            at.append(found)
            others.append(np.full(len(found), other, np.int32))
            labels.append(np.full(len(found), value, np.int32))
            surenesses.append(confidence[found])
    rows = batch.take(pa.array(np.concatenate(at)))
    return pa.record_batch([pa.array(np.concatenate(others)), pa.array(np.concatenate(labels)), pa.array(np.concatenate(surenesses)), *rows.columns], ["other", "label", "confidence", *rows.schema.names])


SALTS = 64


def surest_rows(pool: DataFrame, model: Model, given: list[np.ndarray], sure: float, per_round: int) -> list[Passed]:
    """For each other view and label the ``per_round`` surest rows of the
    whole ``pool`` (key, text, meta): the top of each batch, then of salted
    groups, then of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield _sure_rows(batch, model, given, sure, per_round)

    found = pool.mapInArrow(run, "other int, label int, confidence double, key long, text array<double>, meta array<long>")
    for groups in (["other", "label", "salt"], ["other", "label"]):
        order = W.partitionBy(*groups).orderBy(F.desc("confidence"), "key")
        found = found.withColumn("salt", F.pmod("key", F.lit(SALTS))).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_round)
    got = found.select("other", "label", "confidence", "key", "text", "meta").toArrow()
    out: list[Passed] = []
    for other in (1, 0):
        for value in (1, 0):
            own = got.filter(pc.and_(pc.equal(got.column("other"), other), pc.equal(got.column("label"), value))).sort_by([("confidence", "descending"), ("key", "ascending")]).combine_chunks()
            if len(own):
                text, meta = (own.column(c).combine_chunks().flatten().to_numpy().reshape(len(own), -1) for c in ("text", "meta"))
                out.append((other, own.column("key").to_numpy(), text, meta, value))
    return out


def _feature_batches(n_meta: int, model: Model | None):
    """(row columns) -> features for training, or scores with a model; the
    columns are text, the metadata, then whatever passes through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for lo, hi in row_slices(offsets):
                part = batch.slice(lo, hi - lo)
                text = text_features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                meta = metadata_values([np.diff(offsets[lo : hi + 1]).tolist(), *(part.column(k).to_pylist() for k in range(1, 1 + n_meta))])
                rest = [part.column(k) for k in range(1 + n_meta, part.num_columns)]
                names = part.schema.names[1 + n_meta :]
                if model is None:
                    lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel())) for x in (text, meta)]
                    yield pa.record_batch([*rest, *lists], [*names, "text", "meta"])
                else:
                    a, b, c = model.scores(text, meta)
                    yield pa.record_batch([*rest, pa.array(a), pa.array(b), pa.array(c)], [*names, "text_score", "meta_score", "score"])

    return run


def _inputs(docs: DataFrame, text_col: str, meta_cols: list[str]) -> list[Column]:
    numeric = (T.NumericType,)
    meta = [F.col(c).cast("double" if isinstance(docs.schema[c].dataType, numeric) else "string").alias(f"meta_{k}") for k, c in enumerate(meta_cols)]
    return [F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text_in"), *meta]


def _means(features: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of each text feature over all rows."""
    columns = [F.get("text", F.lit(k)) for k in range(len(TEXT_FEATURES))]
    row = features.agg(*(f(c).alias(f"{n}{k}") for k, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    got = np.array([[row[f"{n}{k}"] or 0.0 for k in range(len(TEXT_FEATURES))] for n in "ms"]).round(9)
    return got[0], got[1] + 1e-6


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", meta_cols: tuple[str, ...] = ("lang", "source", "n_chars"), max_labelled: int = 20_000, rounds: int = 5, sure: float = 0.95, per_round: int = 1000, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from at most ``max_labelled`` labelled rows and all unlabelled
    ones. Without labels every document is accepted. Of the rows of one id
    one takes part; rows without an id are unlabelled, and of those with equal
    features one takes part."""
    meta_cols = [c for c in meta_cols if c in docs.columns]
    with scratch(docs.sparkSession):
        rows = docs.select(*_inputs(docs, text_col, meta_cols), F.col(id_col).cast("long").alias("id"))
        features = written(rows.mapInArrow(_feature_batches(len(meta_cols), None), "id long, text array<double>, meta array<long>"), "quality-features")
        center, scale = _means(features)
        labelled = labelled_sample(labels, label_col, max_labelled, id_col)
        got = one_per_id(features.join(labelled, "id")).select("id", "label", "text", "meta").toArrow()
        marked = labels.select(F.col(id_col).cast("long").alias("id")).filter("id is not null").distinct()
        free = features.join(marked, "id", "left_anti")
        free = free.withColumn("key", F.when(F.col("id").isNull(), F.xxhash64("text", "meta")).otherwise(F.xxhash64("id", F.lit("id"))))
        pool = written(one_per_id(free.select(F.col("key").alias("id"), "text", "meta")).select(F.col("id").alias("key"), "text", "meta"), "quality-pool")
        id_, label = (got.column(k).to_numpy().astype(np.int64) for k in (0, 1))
        order = np.argsort(id_)
        text, meta = (got.column(k).combine_chunks().flatten().to_numpy().reshape(len(id_), n)[order] for k, n in ((2, len(TEXT_FEATURES)), (3, 1 + len(meta_cols))))
        id_, label = id_[order], label[order]
        fold = np.array([xxhash.xxh64_intdigest(str(i), 7) % 5 for i in id_.tolist()], np.int64)
        if not len(id_):
            rounds = 0
        return co_train(text, meta, label, fold, center, scale, lambda model, given: surest_rows(pool, model, given, sure, per_round), rounds, threshold)


def score(docs: DataFrame, model: Model, meta_cols: tuple[str, ...] = ("lang", "source", "n_chars"), keep_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep_cols`` of every row, text_score, meta_score, score, accepted.

    A null text is empty; a null metadata value is a value of its own, and
    metadata columns that the table lacks are left out (as in training).
    Repeated rows score alike. Columns named like an added one can't be
    kept. An empty table gives no rows.
    """
    meta_cols = [c for c in meta_cols if c in docs.columns]
    rows = docs.select(*_inputs(docs, text_col, meta_cols), *(F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep_cols)))
    kept = [T.StructField(f"keep_{k}", docs.schema[c].dataType) for k, c in enumerate(keep_cols)]
    schema = T.StructType([*kept, *(T.StructField(c, T.DoubleType()) for c in ("text_score", "meta_score", "score"))])
    out = rows.mapInArrow(_feature_batches(len(meta_cols), model), schema)
    return out.select(*(F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep_cols)), "text_score", "meta_score", "score", (F.col("score") >= model.threshold).alias("accepted"))
