"""Bounded labelled samples, and logistic regression in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, of: int) -> F.Column:
    """crc32 of the identifier as text, modulo ``of``."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(of))


def sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, usable: F.Column, each: int) -> DataFrame:
    """Documents with label 0 or 1 in ``_y``: of each label the ``each`` identifiers with the smallest hash, whole texts.

    At most 2 * each labelled identifiers, so the joined side is small by construction; documents stay distributed. Of rows
    that repeat an identifier the smallest text counts, so the sample has at most 2 * each rows.
    """
    rows = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y")).filter(F.col("_id").isNotNull() & usable)
    rows = rows.groupBy("_id").agg(F.max("_y").alias("_y"))
    parts = [rows.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(each) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text")).join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.max("_y").alias("_y"), F.min("_text").alias("_text"))


def shares(labels: DataFrame, label: str, id_col: str, usable: F.Column) -> tuple[int, int]:
    """How many usable rows have label 0 and label 1."""
    r = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y")).filter(usable)
    r = r.agg(F.count(F.when(F.col("_y") == 0, 1)), F.count(F.when(F.col("_y") == 1, 1))).first()
    return int(r[0]), int(r[1])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression, the last one the intercept, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.ones(len(x)) if weight is None else weight
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2 * max(weight.sum(), 1.0) / 100)
    ridge[-1] *= 1e-3
    for _ in range(steps):
        p = sigmoid(x @ w)
        g = x.T @ (weight * (p - y)) + ridge * w
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(h, g)
        size = np.abs(step).max()
        w -= step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-6:
            break
    return w
