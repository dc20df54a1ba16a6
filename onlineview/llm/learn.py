"""Bounded labelled samples and the small models trained on them.

A sample holds at most ``per_class`` labelled documents of each class, chosen by
a hash of the id, and is the only thing that reaches the driver. Scoring always
covers every document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import bytes_of

#: Rows with this crc32(doc_id as text) mod 4 are never learnt from.
HELD_OUT = 2


def fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4


def base_counts(labels: DataFrame, target: str) -> tuple[int, int]:
    rows = (labels.filter(F.col(target).isin(0, 1) & (fold() != HELD_OUT))
            .groupBy(F.col(target).cast("int").alias("y")).count().collect())
    n = {r.y: r["count"] for r in rows}
    return n.get(0, 0), n.get(1, 0)


def labelled(docs: DataFrame, labels: DataFrame, target: str, per_class: int) -> DataFrame:
    """(doc_id, y, text bytes) of at most ``2 * per_class`` labelled documents outside the held-out fold.

    The ids are picked on the thin label table; a repeated doc_id contributes one text.
    """
    lab = (labels.select("doc_id", F.col(target).cast("int").alias("y"))
           .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (fold() != HELD_OUT))
           .groupBy("doc_id").agg(F.max("y").alias("y")))
    pick = None
    for y in (0, 1):
        part = lab.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        pick = part if pick is None else pick.union(part)
    texts = docs.select("doc_id", bytes_of("text")).filter(F.col("text").isNotNull())
    # the picked ids are at most 2 * per_class rows, so their broadcast has a fixed bound
    return (texts.join(F.broadcast(pick), "doc_id")
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")))


@dataclass
class Sparse:
    """Rows of (index, value) pairs: row i holds positions at[i] to at[i + 1]."""

    at: np.ndarray
    idx: np.ndarray
    val: np.ndarray

    @classmethod
    def collect(cls, rows: list) -> Sparse:
        idx = [np.frombuffer(r.idx, np.int32) for r in rows]
        val = [np.frombuffer(r.val, np.float32) for r in rows]
        at = np.concatenate(([0], np.cumsum([len(x) for x in idx], dtype=np.int64)))
        empty = np.zeros(0)
        return cls(at, np.concatenate([empty.astype(np.int32), *idx]), np.concatenate([empty.astype(np.float32), *val]))

    def take(self, rows: np.ndarray) -> Sparse:
        pos = np.concatenate([np.zeros(0, np.int64)] + [np.arange(self.at[i], self.at[i + 1]) for i in rows])
        at = np.concatenate(([0], np.cumsum(self.at[rows + 1] - self.at[rows])))
        return Sparse(at, self.idx[pos], self.val[pos])

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def row_sum(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of rows of ``values``, the last axis kept."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


class AdaGrad:
    def __init__(self, shape, lr: float):
        self.g, self.lr = np.full(shape, 1e-6), lr

    def step(self, param, at, grad) -> None:
        """Adds -lr * grad, scaled by each entry's past gradients, to param[at] (``at`` without repeats)."""
        self.g[at] += grad * grad
        param[at] -= self.lr * grad / np.sqrt(self.g[at])


def fit_machine(x: Sparse, y: np.ndarray, size: int, rank: int, *, epochs: int, lr: float, l2: float,
                batch: int = 128, seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss by AdaGrad; (w0, w, v). ``rank`` 0 is logistic regression, else a factorisation machine."""
    rng = np.random.default_rng(seed)
    w, v, w0 = np.zeros(size), rng.normal(0, 0.02, (size, rank)), np.zeros(1)
    ow, ov, o0 = AdaGrad(size, lr), AdaGrad((size, rank), lr / 2), AdaGrad(1, lr)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            rows = order[i:i + batch]
            b = x.take(rows)
            used, inv = np.unique(b.idx, return_inverse=True)
            r = b.row
            z = w0[0] + row_sum(w[b.idx] * b.val, b.at)
            if rank:
                vx = v[b.idx] * b.val[:, None]
                s = row_sum(vx, b.at)
                z += 0.5 * (s * s - row_sum(vx * vx, b.at)).sum(1)
            d = (sigmoid(z) - y[rows]) / len(rows)
            gw = np.bincount(inv, d[r] * b.val, len(used)) + l2 * w[used]
            if rank:
                gv = np.stack([np.bincount(inv, d[r] * b.val * (s[r, k] - vx[:, k]), len(used)) for k in range(rank)], 1)
                ov.step(v, used, gv + l2 * v[used])
            ow.step(w, used, gw)
            o0.step(w0, np.array([0]), np.array([d.sum()]))
    return float(w0[0]), w.astype(np.float32), v.astype(np.float32)


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of the calibrated probability sigmoid(a * z + b), by Newton steps on smoothed targets."""
    n1, n0 = float(y.sum()), float((1 - y).sum())
    if not n0 or not n1:
        return 1.0, 0.0
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * z + b)
        q = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - t) * z).sum() + 1e-3 * (a - 1), (p - t).sum()])
        h = np.array([[(q * z * z).sum() + 1e-3, (q * z).sum()], [(q * z).sum(), q.sum() + 1e-6]])
        da, db = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-7:
            break
    return (a, b) if a > 0 else (1.0, 0.0)


def prior_shift(base: tuple[int, int], sample: np.ndarray) -> float:
    """What to add to a score's logit when a class-balanced sample stands for labels with counts ``base``."""
    s1 = float(sample.sum())
    s0 = len(sample) - s1
    if not (s0 and s1 and base[0] and base[1]):
        return 0.0
    return float(np.log(base[1] / base[0]) - np.log(s1 / s0))
