"""Bounded samples of labelled documents, and a small logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.llm.runtime import work_dir, written

#: Labelled rows that a model is fitted on at most: those whose ids have the least hashes.
SAMPLE_ROWS = 12_000


def remainder(doc_id: Column, modulus: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, label) of at most `rows` labelled rows that aren't held out, as a written table.

    Rows without a label or id are left out; an id that is labelled twice with
    different labels is taken as 1 if any says so, and of several documents
    with one id the least text stands for it.
    """
    picked = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), modulus) != held_out))
        .groupBy("doc_id").agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    found = found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label")
    return written(found, work_dir(docs.sparkSession, "sample"))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50, bias: bool = True) -> np.ndarray:
    """Weights, the bias last, by Newton steps on the mean logistic loss."""
    if bias:
        x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) / len(y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
