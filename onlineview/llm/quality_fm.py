"""Quality classifier: a factorisation machine over hashed words, structure statistics and length metadata.

score = sigmoid(w0 + sum w_f x_f + sum_{f<g} <v_f, v_g> x_f x_g); the pairwise part is
computed in linear time as half of (square of sums minus sum of squares) per factor.

Defined results: a null or empty text has no words and is scored from its (empty)
structure; very long texts are read whole; repeated rows get equal scores; a score at the
threshold is kept; other columns are never read. Without
both classes among the labels every score is the smoothed share of label 1 and the
filter keeps every row. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import learn
from .text import CHUNK_BYTES, Words, blob, bytes_of, chunks, code_points, filtered, mapped, segment_sum

#: Labelled rows learnt from, for each class.
PER_CLASS = 2500
WORD_BITS = 16
RANK = 8
THRESHOLD = 0.7

_EDGES = np.array([1e-9, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95])
_STATS = 12
_SLOTS = 32
SIZE = (1 << WORD_BITS) + _STATS * _SLOTS


def _is(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


_UPPER, _LOWER = _is("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _is("abcdefghijklmnopqrstuvwxyz")
_DIGIT, _SYMBOL, _BANG, _BAR = _is("0123456789"), _is("#*$%&<>^~{}[]=+\\_@"), _is("!?"), _is("|")


def features(data: np.ndarray, offs: np.ndarray) -> learn.Sparse:
    """Feature rows of a run of documents."""
    n = len(offs) - 1
    w = Words(data, offs)
    h = w.hash
    bucket = (h >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    key, times = np.unique((w.doc << WORD_BITS) | bucket, return_counts=True)
    doc, idx = key >> WORD_BITS, key & ((1 << WORD_BITS) - 1)
    val = np.log1p(times)
    norm = np.sqrt(np.bincount(doc, val * val, n))
    val = val / norm[doc]

    size = np.maximum(np.diff(offs), 1)
    words = np.maximum(w.count, 1)
    letters = np.maximum(segment_sum(_UPPER[data] | _LOWER[data], offs), 1)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    shares = [
        segment_sum(_UPPER[data], offs) / letters,
        segment_sum(_DIGIT[data], offs) / size,
        segment_sum(_SYMBOL[data], offs) / size * 4,
        segment_sum(_BANG[data], offs) / size * 4,
        segment_sum(_BAR[data], offs) / size * 4,
        np.bincount(w.doc[same], minlength=n) / words,
        np.bincount(doc, minlength=n) / words,
        np.bincount(doc, times == 1, n) / words,
        np.bincount(doc, times.astype(float) ** 2, n) / words ** 2,
    ]
    counts = [w.count, code_points(data, offs), (np.diff(offs) / words).astype(np.int64) * 16]
    slots = [np.searchsorted(_EDGES, s, "right") for s in shares]
    slots += [np.minimum(np.log2(c + 1).astype(np.int64), _SLOTS - 1) for c in counts]
    stat = np.stack([(1 << WORD_BITS) + k * _SLOTS + s for k, s in enumerate(slots)], 1)

    idx = np.concatenate((idx, stat.ravel())).astype(np.int32)
    val = np.concatenate((val, np.full(stat.size, 0.5))).astype(np.float32)
    order = np.argsort(np.concatenate((doc, np.repeat(np.arange(n), _STATS))), kind="stable")
    at = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n) + _STATS)))
    return learn.Sparse(at, idx[order], val[order])


@dataclass
class QualityFM:
    w0: float
    w: np.ndarray | None
    v: np.ndarray | None

    def score(self, texts: pa.Array) -> np.ndarray:
        data, offs = blob(texts)
        if self.w is None:
            return np.full(len(offs) - 1, learn.sigmoid(self.w0))
        out = [np.zeros(0)]
        for i, j in chunks(offs, CHUNK_BYTES):
            x = features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            vx = self.v[x.idx] * x.val[:, None]
            s, q = learn.row_sum(vx, x.at), learn.row_sum(vx * vx, x.at)
            out.append(learn.sigmoid(self.w0 + learn.row_sum(self.w[x.idx] * x.val, x.at) + 0.5 * (s * s - q).sum(1)))
        return np.concatenate(out)


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = PER_CLASS) -> QualityFM:
    """Learn from at most ``per_class`` labelled documents of each class outside the held-out fold."""
    base = learn.base_counts(labels, target)

    def each(b):
        data, offs = blob(b.column(2))
        idx, val = [], []
        for i, j in chunks(offs):
            x = features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            idx += [x.idx[p:q].tobytes() for p, q in zip(x.at[:-1], x.at[1:])]
            val += [x.val[p:q].tobytes() for p, q in zip(x.at[:-1], x.at[1:])]
        return {"doc_id": b.column(0), "y": b.column(1), "idx": pa.array(idx, pa.binary()), "val": pa.array(val, pa.binary())}

    sample = learn.labelled(docs, labels, target, per_class).select(F.col("doc_id").cast("long"), "y", "text")
    rows = sorted(mapped(sample, each, "doc_id long, y int, idx binary, val binary").collect(), key=lambda r: r.doc_id)
    y = np.array([r.y for r in rows], float)
    if not 0 < y.sum() < len(y):
        return QualityFM(float(np.log((base[1] + 1) / (base[0] + 1))), None, None)
    w0, w, v = learn.fit_machine(learn.Sparse.collect(rows), y, SIZE, RANK, epochs=6, lr=0.1, l2=1e-5)
    return QualityFM(w0 + learn.prior_shift(base, y), w, v)


def score(docs: DataFrame, model: QualityFM) -> DataFrame:
    """doc_id, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of("text")),
                  lambda b: {"doc_id": b.column(0), "score": pa.array(shared.value.score(b.column(1)))},
                  "doc_id long, score double")


def keep(docs: DataFrame, model: QualityFM, threshold: float = THRESHOLD) -> DataFrame:
    """The rows scored at least ``threshold``, columns unchanged."""
    if model.w is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filtered(docs, "text", lambda t: shared.value.score(t.cast(pa.binary())) >= threshold)
