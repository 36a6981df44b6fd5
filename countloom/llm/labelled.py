"""Bounded samples of labelled documents, and small logistic fits on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from countloom.llm.common import checksum, materialise, text_of


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the row must not be learned from; a null id is."""
    return F.coalesce(checksum(doc_id) % folds == fold, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, most: int) -> DataFrame:
    """``(label, text)`` of at most ``most`` labelled documents outside the held-out fold, by order of a hash.

    Null labels are left out; a document labelled twice has its larger label.
    """
    usable = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    chosen = (
        usable.where(~held_out(F.col("doc_id"), folds, fold))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = docs.select("doc_id", text_of().alias("text"))
    # ``most`` bounds what is broadcast.
    return materialise(texts.join(F.broadcast(chosen), "doc_id").select("label", "text"), "labelled")


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights by Newton's method, drawn towards ``prior``."""
    w = prior.astype(float).copy()
    if not len(x):
        return w
    eye = np.eye(x.shape[1]) * strength
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + strength * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + eye
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w
