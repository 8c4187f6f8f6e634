"""Small logistic fits on a bounded sample of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.names import col
from daybook.llm.common import held_out, order_hash, picked, utf8


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    max_docs: int,
    max_bytes: int,
    seed: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> list[tuple[str, int]]:
    """Texts and labels to learn from: at most ``max_docs``, of ``max_bytes`` each.

    Rows of the held-out fold are left out, as are null labels, ids with two labels
    and longer texts. The choice is the first by a seeded hash, so reruns agree.
    """
    one = (
        labels.select(col(id_col).alias("doc_id"), col(label_col).cast("int").alias("label"))
        .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .orderBy(order_hash("doc_id", seed=seed), "doc_id")
        .limit(max_docs)
        .select("doc_id", "label")
    )
    texts = picked(docs, doc_id=id_col, text=text_col).where(F.octet_length(utf8(F.col("text"))) <= max_bytes)
    # At most max_docs ids and labels.
    rows = texts.join(F.broadcast(one), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    found = sorted((r["doc_id"], r["text"] or "", r["label"]) for r in rows.toLocalIterator())
    return [(text, label) for _, text, label in found]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights and, last, the constant of a logistic fit on a few columns (Newton's method)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) / len(y) + l2 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w
