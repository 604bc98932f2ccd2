"""Labelled rows for the classifiers, and the logistic fits they share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text, modulo ``n``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def verdicts(labels: DataFrame, column: str) -> DataFrame:
    """One 0/1 label per doc_id: (doc_id, y); ids with null, other or contradicting labels are left out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    return known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("high")).filter("y = high").select("doc_id", "y")


def sample(labelled: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled ids of each class, those with the smallest hash: (doc_id, y, rank).

    ``rank`` is the hash, so that halves of the sample can be told apart.  It is small by its
    bound, so joins may broadcast it.
    """
    ranked = labelled.withColumn("rank", F.xxhash64("doc_id", F.lit(7)))
    return ranked.filter("y = 0").orderBy("rank").limit(per_class).union(ranked.filter("y = 1").orderBy("rank").limit(per_class))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights (the last is the intercept) of a dense logistic regression by Newton's method with step halving."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).mean() + 0.5 * ridge * w @ w)

    now = loss(w)
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) / len(y) + ridge * w
        curve = (x.T * np.maximum(p * (1 - p), 1e-6)) @ x / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        while (then := loss(w - step)) > now and np.abs(step).max() > 1e-10:
            step = step / 2
        if then > now or np.abs(step).max() < 1e-8:
            break
        w, now = w - step, then
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
