"""Logistic regression by Newton steps, and bounded labelled samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, prior: np.ndarray | None = None, weight: np.ndarray | None = None, steps: int = 30) -> np.ndarray:
    """Coefficients (the last is the intercept) that maximise the
    posterior under a normal prior of precision ``ridge`` around ``prior``;
    the intercept has a tenth of it. ``x`` may have no rows."""
    x = np.c_[x, np.ones(len(x))]
    prior = np.zeros(x.shape[1]) if prior is None else prior
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = ridge / 10
    weight = np.ones(len(x)) if weight is None else weight
    b = prior.astype(float).copy()

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (penalty * (b - prior) ** 2).sum())

    now = loss(b)
    for _ in range(steps):
        p = sigmoid(x @ b)
        gradient = x.T @ (weight * (p - y)) + penalty * (b - prior)
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-4 and loss(b - size * move) > now:
            size /= 2
        b, before = b - size * move, now
        now = loss(b)
        if before - now < 1e-8 * (1 + abs(now)):
            break
    return b


def fit_values(x: np.ndarray, y: np.ndarray, size: int, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """As ``fit`` for rows that hold a few of very many indicators: ``x`` has
    their numbers, below ``size``. Newton steps whose equations are solved by
    conjugate gradients, so memory goes with the rows and indicators only."""
    n, k = x.shape
    flat = x.ravel()
    penalty = np.r_[np.full(size, ridge), ridge / 10]

    def times(b: np.ndarray) -> np.ndarray:
        return b[flat].reshape(n, k).sum(axis=1) + b[-1]

    def back(r: np.ndarray) -> np.ndarray:
        return np.r_[np.bincount(flat, np.repeat(r, k), size), r.sum()]

    def loss(b: np.ndarray) -> float:
        z = times(b)
        return float((np.logaddexp(0, z) - y * z).sum() + 0.5 * (penalty * b * b).sum())

    b = np.zeros(size + 1)
    now = loss(b)
    for _ in range(steps):
        p = sigmoid(times(b))
        gradient = back(p - y) + penalty * b
        spread = p * (1 - p)
        move, rest = np.zeros_like(b), gradient.copy()
        along, length = rest.copy(), float(rest @ rest)
        for _ in range(200):
            if length < 1e-16 * (1 + float(gradient @ gradient)):
                break
            bent = back(spread * times(along)) + penalty * along
            step = length / float(along @ bent)
            move, rest = move + step * along, rest - step * bent
            length, before = float(rest @ rest), length
            along = rest + length / before * along
        size_of_step = 1.0
        while size_of_step > 1e-4 and loss(b - size_of_step * move) > now:
            size_of_step /= 2
        b, before = b - size_of_step * move, now
        now = loss(b)
        if before - now < 1e-8 * (1 + abs(now)):
            break
    return b


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def predict(b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The logits of the rows of ``x``."""
    return x @ b[:-1] + b[-1]


def labelled_sample(labels: DataFrame, label_col: str, max_rows: int, id_col: str = "doc_id", only=None) -> DataFrame:
    """(id, label) of at most ``max_rows`` labelled rows, in the order of a
    hash of the id. Rows with a null id or label are left out; of several
    labels of an id the mean decides."""
    rows = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("label")).filter("id is not null and label is not null")
    if only is not None:
        rows = rows.filter(only(F.col("id")))
    rows = rows.groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    return rows.orderBy(F.xxhash64("id"), "id").limit(max_rows)


def one_per_id(rows: DataFrame) -> DataFrame:
    """Of the rows of each ``id`` the one with the least hash, so that a
    sample bounded in ids is bounded in rows too."""
    rest = [c for c in rows.columns if c != "id"]
    return rows.groupBy("id").agg(F.min(F.struct(F.xxhash64(*rest).alias("order"), *rest)).alias("one")).select("id", *(f"one.{c}" for c in rest))
