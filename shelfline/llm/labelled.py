"""Bounded training samples of labelled documents, and a small logistic regression.

The sample is the only part of a classifier that is bounded: at most ``rows``
labelled documents per class, the first by a hash of their id, so that reruns
agree and every document has the same chance.  Scoring covers every document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id has the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                  rows: int) -> tuple[pd.DataFrame, float]:
    """text and label (0/1) of at most ``rows`` training documents per class, no text twice, and
    the logarithm of the odds of label 1 among all training labels.

    Ids come from ``labels`` first (bounded, so broadcast), then meet the texts in one scan.
    An id labelled twice takes the larger label; null ids, labels and texts are left out.  The
    sample's own odds change once a class is larger than ``rows``; those of all labels do not.
    """
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
           .where(fold(F.col("doc_id"), folds) != held_out)
           .groupBy("doc_id").agg(F.max(label).alias("label")))
    pick = lambda y: (ids.where(F.col("label") == y)
                      .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    chosen = pick(0).unionByName(pick(1))
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.col("text") != ""))
    found = texts.join(F.broadcast(chosen), "doc_id").toPandas()
    total = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    odds = float(np.log((total.get(1, 0) + 1) / (total.get(0, 0) + 1)))
    return found.sort_values(["doc_id", "text"]).drop_duplicates("text").reset_index(drop=True), odds


def class_weights(y: np.ndarray, odds: float) -> np.ndarray:
    """Weights of sampled rows that give the classes the odds (logarithm) of all labels; the larger
    class weighs one a row at most."""
    ones = y.sum()
    tilt = np.exp(odds) * (len(y) - ones) / max(ones, 1e-9) if 0 < ones < len(y) else 1.0
    return np.where(y == 1, min(1.0, tilt), min(1.0, 1.0 / tilt))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def logistic(x: np.ndarray, y: np.ndarray, centre: np.ndarray, spread: np.ndarray, steps: int = 60,
             rows: np.ndarray | None = None) -> np.ndarray:
    """Newton fit with step halving of weights (last one the intercept), under a normal prior
    around ``centre``; ``rows`` weighs the rows."""
    a = np.column_stack([x, np.ones(len(x))])
    w = centre.astype(float).copy()
    m = np.ones(len(y)) if rows is None else rows

    def loss(v: np.ndarray) -> float:
        z = a @ v
        return float((m * (np.logaddexp(0.0, z) - y * z)).sum() + (((v - centre) / spread) ** 2).sum() / 2)

    now = loss(w)
    for _ in range(steps):
        p = sigmoid(a @ w)
        gradient = a.T @ (m * (p - y)) + (w - centre) / spread ** 2
        curve = (a * (m * p * (1 - p))[:, None]).T @ a + np.diag(1 / spread ** 2)
        step = np.linalg.solve(curve, gradient)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-9:
            break
    return w
