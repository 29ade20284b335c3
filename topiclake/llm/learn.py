"""Labelled text for the classifiers: a bounded sample, and logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import cut, sampled


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """(id, text, y) of about ``rows`` labelled documents of each class at most, and the class sizes.

    The sample of the labels is of bounded size and joins the documents by broadcast.
    Labels other than 0 and 1, null ids and documents without label are not taken.  Of documents that share an id the
    least text is, so repeated rows don't enlarge the sample.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).distinct()
    few, sizes = sampled(known, "id", "y", rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return cut(texts.join(F.broadcast(few), "id").groupBy("id", "y").agg(F.min("text").alias("text")).select("id", "text", "y")), sizes


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression (the last is the constant), by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
