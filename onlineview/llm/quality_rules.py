"""Quality rules: fixed counting rules, then a calibrated logistic regression on hashed word and character n-grams.

A document that fails a counting rule is out. Of the rest, the regression's
probability, calibrated on a quarter of the labelled sample it was not fitted on,
is compared with a fixed threshold.

Defined results: a null or empty text has no words and fails the word-count rule;
very long texts are read whole; repeated rows get equal results; a score at the threshold
is kept; other columns are never read; an empty table gives an empty result. Without both classes among the labels the regression keeps every text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import learn
from .text import SPACE, Words, blob, bytes_of, chunks, mapped, segment_sum

PER_CLASS = 1500
BITS = 16
GRAM = 4
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
THRESHOLD = 0.5
SIZE = 2 << BITS

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_GRAM_MUL = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def _grams(data: np.ndarray) -> np.ndarray:
    """Bucket of the byte n-gram at each position (those that leave the run are missing)."""
    n = max(len(data) - GRAM + 1, 0)
    acc = np.zeros(n, np.uint32)
    for j in range(GRAM):
        acc += (data[j:j + n].astype(np.uint32) + np.uint32(1)) * _GRAM_MUL[j]
        acc ^= acc >> np.uint32(15)
    acc *= np.uint32(0x2C1B3C6D)
    return acc >> np.uint32(32 - BITS)


def _repeat_words(h: np.ndarray) -> int:
    """Words inside 3-word windows that occur at least twice, for one text's word hashes."""
    if len(h) < 4:
        return 0
    ids = np.unique(h, return_inverse=True)[1].astype(np.int64)
    n = int(ids.max()) + 1
    pair = np.unique(ids[:-2] * n + ids[1:-1], return_inverse=True)[1]
    win, count = np.unique(pair * n + ids[2:], return_inverse=True, return_counts=True)[1:]
    hit = np.flatnonzero(count[win] > 1)
    covered = np.zeros(len(h), bool)
    for j in range(3):
        covered[hit + j] = True
    return int(covered.sum())


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def statistics(data: np.ndarray, offs: np.ndarray, w: Words) -> dict[str, np.ndarray]:
    """The counting rules' numbers for a run of documents."""
    h = w.hash
    text = data.tobytes()
    return {
        "n_words": w.count.astype(np.int64),
        "word_chars": segment_sum(((data & 0xC0) != 0x80) & ~SPACE[data], offs),
        "n_symbols": segment_sum(_SYMBOL[data], offs),
        "n_dup_lines": np.array([_dup_lines(text[a:b]) for a, b in zip(offs[:-1], offs[1:])], np.int64),
        "n_repeat_words": np.array([_repeat_words(h[a:b]) for a, b in zip(w.bounds[:-1], w.bounds[1:])], np.int64),
    }


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


@dataclass
class Regression:
    w0: float
    w: np.ndarray | None
    scale: float = 1.0
    shift: float = 0.0

    def probability(self, data: np.ndarray, offs: np.ndarray, w: Words) -> np.ndarray:
        """Calibrated probability of label 1 for a run of documents; each kind of n-gram enters as its mean."""
        if self.w is None:
            return np.ones(len(offs) - 1)
        words = segment_sum(self.w[(w.hash >> np.uint64(64 - BITS)).astype(np.int64)].astype(float), w.bounds)
        grams = segment_sum(self.w[(1 << BITS):][_grams(data)].astype(float), offs, GRAM - 1)
        z = self.w0 + words / np.maximum(w.count, 1) + grams / np.maximum(np.diff(offs) - GRAM + 1, 1)
        return learn.sigmoid(self.scale * z + self.shift)


def _rows(data: np.ndarray, offs: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Training rows: share of each bucket among the document's words and among its byte n-grams."""
    w, out = Words(data, offs), []
    wb, gb = (w.hash >> np.uint64(64 - BITS)).astype(np.int64), _grams(data).astype(np.int64) + (1 << BITS)
    for i in range(len(offs) - 1):
        idx, val = [], []
        for part in (wb[w.bounds[i]:w.bounds[i + 1]], gb[offs[i]:max(offs[i], offs[i + 1] - GRAM + 1)]):
            if len(part):
                b, c = np.unique(part, return_counts=True)
                idx.append(b)
                val.append(c / len(part))
        none = np.zeros(0)
        out.append((np.concatenate([none, *idx]).astype(np.int32).tobytes(), np.concatenate([none, *val]).astype(np.float32).tobytes()))
    return out


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = PER_CLASS) -> Regression:
    """Learn from at most ``per_class`` labelled documents of each class; every fourth only calibrates."""
    base = learn.base_counts(labels, target)

    def each(b):
        data, offs = blob(b.column(2))
        rows = [r for i, j in chunks(offs) for r in _rows(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])]
        return {"doc_id": b.column(0), "y": b.column(1), "idx": pa.array([r[0] for r in rows], pa.binary()), "val": pa.array([r[1] for r in rows], pa.binary())}

    sample = learn.labelled(docs, labels, target, per_class).select(F.col("doc_id").cast("long"), "y", "text")
    rows = sorted(mapped(sample, each, "doc_id long, y int, idx binary, val binary").collect(), key=lambda r: r.doc_id)
    y = np.array([r.y for r in rows], float)
    held = np.arange(len(y)) % 4 == 3
    if not 0 < y[~held].sum() < (~held).sum():
        return Regression(0.0, None)
    x = learn.Sparse.collect(rows)
    train = np.flatnonzero(~held)
    w0, w, _ = learn.fit_machine(x.take(train), y[train], SIZE, 0, epochs=8, lr=0.6, l2=1e-6)
    h = x.take(np.flatnonzero(held))
    a, b = learn.platt(w0 + learn.row_sum(w[h.idx].astype(float) * h.val, h.at), y[held])
    return Regression(w0, w, a, b + learn.prior_shift(base, y))


def judge(docs: DataFrame, model: Regression, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, base_failed, probability and kept for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "probability", "kept"]

    def each(b):
        data, offs = blob(b.column(1))
        parts = {k: [] for k in names}
        for i, j in chunks(offs):
            d, o = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            w = Words(d, o)
            s = statistics(d, o, w)
            s["base_failed"] = base_failed(s)
            s["probability"] = shared.value.probability(d, o, w)
            s["kept"] = ~s["base_failed"] & (s["probability"] >= threshold)
            for k in names:
                parts[k].append(s[k])
        return {"doc_id": b.column(0)} | {k: pa.array(np.concatenate(v)) for k, v in parts.items()}

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of("text")), each,
                  "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean")
