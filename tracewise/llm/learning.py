"""Shared pieces of the trained operators: folds, bounded samples, logistic regression."""

from __future__ import annotations

from copy import copy

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HELD_OUT = 1


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; fold 1 is never learned from. A null id counts as empty text (fold 0)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, columns: list[str]) -> DataFrame:
    """At most ``most`` labelled training documents (by a hash of the id), with column ``y``.

    Null labels and ids are left out; an id labelled more than once takes its largest
    label. The chosen ids are ``most`` rows at most, which bounds the broadcast.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold() != HELD_OUT))
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", *columns).join(F.broadcast(chosen), "doc_id")


class Logistic:
    """L2-regularised logistic regression by Newton steps on standardised features."""

    def __init__(self, strength: float = 1.0, steps: int = 25):
        self.strength, self.steps = strength, steps

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, scaling: tuple[np.ndarray, np.ndarray] | None = None) -> Logistic:
        """``scaling``: mean and scale of the features; those of ``x`` if not given."""
        w = np.ones(len(y)) if weight is None else weight
        self.mean, self.scale = (x.mean(axis=0), x.std(axis=0) + 1e-9) if scaling is None else scaling
        z = self._standard(x)
        self.beta = np.zeros(z.shape[1])
        for _ in range(self.steps):
            if self._move(*self._sums(z, y, w)) < 1e-6:
                break
        return self

    def sums(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Gradient and curvature of the rows' loss as one flat array; those of parts add up."""
        grad, curve = self._sums(self._standard(x), y, weight)
        return np.concatenate([grad, curve.ravel()])

    def moved(self, sums: np.ndarray) -> Logistic:
        """The model one Newton step further."""
        other, d = copy(self), len(self.beta)
        other._move(sums[:d], sums[d:].reshape(d, d))
        return other

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])

    def _sums(self, z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))
        return z.T @ (w * (p - y)), (z * (w * p * (1 - p) + 1e-6)[:, None]).T @ z

    def _move(self, grad: np.ndarray, curve: np.ndarray) -> float:
        ridge = np.full(len(self.beta), self.strength)
        ridge[-1] = 1e-3
        step = np.linalg.solve(curve + np.diag(ridge), grad + ridge * self.beta)
        self.beta = self.beta - step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        return np.abs(step).max()

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.beta[:-1] + self.beta[-1]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
