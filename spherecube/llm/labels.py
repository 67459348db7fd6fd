"""Training rows for the classifiers: a bounded sample of labelled documents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spherecube.llm.common import id_and_text


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether the id's CRC falls into the part that is never learned from; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(parts)) == part, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, parts: int, part: int, sample: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, label (0 or 1) of at most ``sample`` labelled rows, those whose hashed ids come first.

    Null ids, null labels and held-out rows are left out. The sample's ids are few by that bound and are broadcast.
    """
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
    marks = marks.dropna().filter(~held_out("_id", parts, part)).dropDuplicates(["_id"])
    marks = marks.orderBy(F.xxhash64("_id", F.lit(7)), "_id").limit(sample)
    rows = id_and_text(docs, id_col, text_col)
    return rows.join(F.broadcast(marks), F.col("doc_id") == F.col("_id")).select("doc_id", "text", (F.col("label") == 1).cast("int").alias("label"))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, scales and weights (the constant last) of a ridge-penalised logistic regression, by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w
