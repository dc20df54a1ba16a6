"""Toxicity: cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(w . x - theta_k) for ordered thresholds theta_1 < ... < theta_K that
share one weight vector; the expected severity is the sum of these probabilities.

Features are folded words and their 4- and 5-byte beginnings, hashed; those whose
document frequency differs between the two labels are kept, each with two values:
log(1 + count), and log(1 + count per hundred words). Labels are 0/1, so the training grades of label-1 documents are the thirds of
their count of label-1 evidence (grades 1 to 3); label 0 is grade 0.

Defined results: a null or empty text has no features and gets the base severity;
repeated rows get equal results; ties of features at the limit go to the smaller feature;
very long texts are read whole; other columns are never read; an empty table gives
an empty result. Without both classes among the labels every severity is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import learn
from .text import FOLD, PUNCTUATION, U64, Words, blob, bytes_of, chunks, mapped, mix

PER_CLASS = 3000
BITS = 20
GRADES = 3
MAX_FEATURES = 4096
MIN_Z = 6.5
PER_WORDS = 100
_KINDS = (None, 4, 5)


def _features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and feature of each occurrence in a run of documents, and the documents' words."""
    w = Words(FOLD[data], offs, PUNCTUATION)
    doc, out = [], []
    for k, size in enumerate(_KINDS):
        if size is None:
            h, d = w.hash, w.doc
        else:
            at = np.flatnonzero(w.en - w.st > size)
            h, d = w.hash_to(np.minimum(w.en, w.st + size))[at], w.doc[at]
        out.append(mix(h + U64(k + 1)) >> U64(64 - BITS))
        doc.append(d)
    return np.concatenate(doc), np.concatenate(out).astype(np.int64), w.count


@dataclass
class Ordinal:
    column: np.ndarray | None  # feature -> position in w, -1 for features of no weight
    w: np.ndarray
    theta: np.ndarray

    def rows(self, texts: pa.Array) -> learn.Sparse:
        """Count features (even columns) and rate features (odd ones) of each text."""
        data, offs = blob(texts)
        doc, col, val = [], [], []
        for i, j in chunks(offs):
            d, f, words = _features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            c = self.column[f]
            known = np.flatnonzero(c >= 0)  # few: only these are grouped
            key, n = np.unique(d[known].astype(np.int64) * MAX_FEATURES + c[known], return_counts=True)
            own, at = key // MAX_FEATURES, 2 * (key % MAX_FEATURES)
            doc.append(np.repeat(own + i, 2))
            col.append(np.stack([at, at + 1], 1).ravel())
            val.append(np.log1p(np.stack([n, PER_WORDS * n / words[own]], 1)).ravel())
        none = np.zeros(0)
        doc = np.concatenate([none, *doc]).astype(np.int64)
        at = np.searchsorted(doc, np.arange(len(offs)))
        return learn.Sparse(at, np.concatenate([none, *col]).astype(np.int32), np.concatenate([none, *val]).astype(np.float32))

    def above(self, texts: pa.Array) -> np.ndarray:
        """P(grade > k) for k = 0 .. GRADES - 1, one row per text."""
        if self.column is None:
            return np.zeros((len(texts), GRADES))
        x = self.rows(texts)
        return learn.sigmoid(learn.row_sum(self.w[x.idx] * x.val, x.at)[:, None] - self.theta[None, :])


def fit_ordinal(x: learn.Sparse, grade: np.ndarray, size: int, *, steps: int = 1000, lr: float = 0.3,
                l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(w, theta) by AdaGrad on the mean log-likelihood; gaps between thresholds stay positive as exponentials."""
    n = len(grade)
    w, par = np.zeros(size), np.concatenate(([1.0], np.zeros(GRADES - 1)))  # theta_1, then logs of gaps
    ow, op = learn.AdaGrad(size, lr), learn.AdaGrad(GRADES, lr)
    row, every, each = x.row, np.arange(size), np.arange(GRADES)
    for _ in range(steps):
        gaps = np.exp(par[1:])
        theta = par[0] + np.concatenate(([0.0], np.cumsum(gaps)))
        edge = np.concatenate(([-np.inf], theta, [np.inf]))
        s = learn.row_sum(w[x.idx] * x.val, x.at)
        lo, hi = s - edge[grade], s - edge[grade + 1]
        a = np.where(np.isinf(lo), 1.0, learn.sigmoid(np.nan_to_num(lo, posinf=40)))
        b = np.where(np.isinf(hi), 0.0, learn.sigmoid(np.nan_to_num(hi, neginf=-40)))
        p = np.maximum(a - b, 1e-9)
        ds = -(1 - a - b) / n
        gt = np.zeros(GRADES + 2)
        np.add.at(gt, grade, a * (1 - a) / p / n)
        np.add.at(gt, grade + 1, -b * (1 - b) / p / n)
        gt = gt[1:-1]
        gp = np.concatenate(([gt.sum()], [gt[k + 1:].sum() * gaps[k] for k in range(GRADES - 1)]))
        ow.step(w, every, np.bincount(x.idx, ds[row] * x.val, size) + l2 * w / n ** 0.5)
        op.step(par, each, gp)
    theta = par[0] + np.concatenate(([0.0], np.cumsum(np.exp(par[1:]))))
    return w, theta


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", per_class: int = PER_CLASS) -> Ordinal:
    """Learn from at most ``per_class`` labelled documents of each class outside the held-out fold."""
    sample = learn.labelled(docs, labels, target, per_class).select(F.col("doc_id").cast("long"), "y", "text")

    def count(b):
        data, offs = blob(b.column(2))
        y = b.column(1).to_numpy()
        total = []
        for i, j in chunks(offs):
            d, f, _ = _features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            key = np.unique((d.astype(np.int64) << BITS) | f)
            total.append(np.stack([key & ((1 << BITS) - 1), y[i + (key >> BITS)]], 1))
        total = np.concatenate(total)
        f, inv = np.unique(total[:, 0], return_inverse=True)
        n1 = np.bincount(inv, total[:, 1], len(f)).astype(np.int64)
        return {"f": pa.array(f), "n0": pa.array(np.bincount(inv, minlength=len(f)) - n1), "n1": pa.array(n1)}

    sizes = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    s0, s1 = sizes.get(0, 0), sizes.get(1, 0)
    if not s0 or not s1:
        return Ordinal(None, np.zeros(0), np.zeros(GRADES))
    share = (F.col("n0") + F.col("n1")) / (s0 + s1)
    z = (F.col("n1") / s1 - F.col("n0") / s0) / F.sqrt(share * (1 - share) * (1 / s0 + 1 / s1) + 1e-9)
    kept = (mapped(sample, count, "f long, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
            .withColumn("z", z).filter(F.abs("z") >= MIN_Z)
            .orderBy(F.abs("z").desc(), "f").limit(MAX_FEATURES).collect())
    column = np.full(1 << BITS, -1, np.int16)
    column[[r.f for r in kept]] = np.arange(len(kept))
    blank = Ordinal(column, np.zeros(len(kept)), np.zeros(GRADES))

    def each(b):
        x = blank.rows(b.column(2))
        cut = list(zip(x.at[:-1], x.at[1:]))
        return {"doc_id": b.column(0), "y": b.column(1), "idx": pa.array([x.idx[p:q].tobytes() for p, q in cut], pa.binary()), "val": pa.array([x.val[p:q].tobytes() for p, q in cut], pa.binary())}

    rows = sorted(mapped(sample, each, "doc_id long, y int, idx binary, val binary").collect(), key=lambda r: r.doc_id)
    x, y = learn.Sparse.collect(rows), np.array([r.y for r in rows])
    for_label = np.array([[r.z > 0, False] for r in kept], float).ravel()
    evidence = learn.row_sum(for_label[x.idx] * np.expm1(x.val), x.at)
    grade = np.zeros(len(y), np.int64)
    grade[y == 1] = 1 + np.searchsorted(np.quantile(evidence[y == 1], [1 / 3, 2 / 3]), evidence[y == 1], "left")
    # thresholds stay those of the balanced sample: a few words of evidence decide, whatever the base rate
    return Ordinal(column, *fit_ordinal(x, grade, 2 * len(kept)))


def score(docs: DataFrame, model: Ordinal) -> DataFrame:
    """doc_id, expected_severity (0 to GRADES), grade (thresholds passed), toxic (grade over 0) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(b):
        p = shared.value.above(b.column(1))
        grade = (p >= 0.5).sum(1)
        return {"doc_id": b.column(0), "expected_severity": pa.array(p.sum(1)), "grade": pa.array(grade.astype(np.int32)), "toxic": pa.array(grade > 0)}

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of("text")), each,
                  "doc_id long, expected_severity double, grade int, toxic boolean")
