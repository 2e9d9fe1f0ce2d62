"""Bounded labelled samples and small numpy training helpers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, bound: int, allowed: Column,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of about ``bound`` labelled documents that ``allowed`` admits.

    Labels are picked by a hash of the id, so the sample is the same in every
    run.  The picked ids number about ``bound`` whatever the input holds; that
    parameter is what bounds the broadcast.
    """
    ids = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & allowed)
    ids = ids.groupBy(id_col).agg(F.max(label_col).cast("double").alias("label"))
    n = ids.count()
    u = F.pmod(F.xxhash64(F.lit(5), F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    picked = ids.where(u < min(1.0, bound / max(1, n))).withColumnRenamed(id_col, "_pick")
    hit = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(picked), F.col("_id") == F.col("_pick"))
    return hit.select("_id", "_text", "label")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    """Adam over a dict of arrays; updates in place."""

    def __init__(self, params: dict[str, np.ndarray], rate: float = 1e-3):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, params: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        fix = np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            params[k] -= (self.rate * fix * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(params[k].dtype)


def fit_line(x: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Platt scaling: (a, b) of sigmoid(a x + b), by Newton steps with a weak prior."""
    w = np.array([1.0, 0.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(steps):
        p = sigmoid(design @ w)
        g = design.T @ (p - y) + 1e-2 * (w - np.array([1.0, 0.0]))
        h = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])
