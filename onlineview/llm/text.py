"""Vectorised text work on Arrow batches, shared by the operators of this subpackage.

A batch's binary column is one byte buffer with offsets, so words, n-grams and
their hashes are found with numpy over whole runs of documents instead of per
row. Long texts are taken in windows of bounded size; nothing is cut off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
_WINDOW = 1 << 20
#: Longer words are hashed by xxh3: the sum below is too regular for them (some words of 1,024 bytes over two letters collide).
_LONG_WORD = 64
CHUNK_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64): spreads every input bit over the word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], U64))[0])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


_BASE = 0x2545F4914F6CDD1D
_POW = _powers(_BASE, _WINDOW + _LONG_WORD)
_INV = _powers(pow(_BASE, -1, 1 << 64), _WINDOW)
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))

#: Separators of plain words: space and \x09 to \x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, other bytes as they are.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: Separators of normalised words, which are runs of digits, letters and bytes from \x80.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def blob(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a binary column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, limit: int = CHUNK_BYTES):
    """Runs [i, j) of whole documents with about ``limit`` bytes (a longer document is a run of its own)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words of a run of documents: ``doc`` (index in the run), ``st``, ``en`` (byte positions), ``hash``."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, separators: np.ndarray = SPACE):
        sep = separators[data]
        word = ~sep
        first = np.zeros(len(data) + 1, bool)  # documents touch each other without a separator
        first[offs] = True
        st = np.flatnonzero(word & (np.concatenate(([True], sep[:-1])) | first[:-1])) if len(data) else np.zeros(0, np.int64)
        en = np.flatnonzero(word & (np.concatenate((sep[1:], [True])) | first[1:])) + 1 if len(data) else st
        self.data, self.offs, self.st, self.en = data, offs, st, en
        self.bounds = np.searchsorted(st, offs)  # words of document i: bounds[i] to bounds[i + 1]
        self.count = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(offs) - 1), self.count)

    @property
    def hash(self) -> np.ndarray:
        """64-bit hash of each word's bytes: equal words have equal hashes in any batch."""
        return self.hash_to(self.en)

    def hash_to(self, ends: np.ndarray) -> np.ndarray:
        """The same of each word's bytes up to ``ends`` (its prefix)."""
        out = np.empty(len(self.st), U64)
        long = np.flatnonzero(ends - self.st > _LONG_WORD)
        en = ends.copy()
        en[long] = self.st[long]
        edges = np.searchsorted(self.st, np.arange(0, len(self.data) + _WINDOW, _WINDOW))
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if a == b:
                continue
            base = k * _WINDOW
            part = self.data[base:int(en[a:b].max())]
            total = np.zeros(len(part) + 1, U64)
            np.cumsum(_BYTE[part] * _POW[:len(part)], out=total[1:])
            s = self.st[a:b] - base
            out[a:b] = (total[np.maximum(en[a:b] - base, s)] - total[s]) * _INV[s]
        out = mix(out + U64(0x632BE59BD9B4E019) * (ends - self.st).astype(U64))
        for i in long:
            out[i] = xxhash.xxh3_64_intdigest(self.data[self.st[i]:ends[i]].tobytes())
        return out


def code_points(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Code points of each document of a run."""
    return segment_sum((data & 0xC0) != 0x80, offs)


def segment_sum(values: np.ndarray, offs: np.ndarray, tail: int = 0) -> np.ndarray:
    """Sum of ``values`` over [offs[i], offs[i + 1] - tail) for each i, 0 where that is empty."""
    kind = np.float64 if values.dtype.kind == "f" else np.int64
    total = np.zeros(len(values) + 1, kind)
    np.cumsum(values, out=total[1:], dtype=kind)
    hi = np.minimum(np.maximum(offs[1:] - tail, offs[:-1]), len(values))
    return total[hi] - total[np.minimum(offs[:-1], len(values))]


def windows(w: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every run of k words within one document."""
    if len(h) < k:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    n = len(h) - k + 1
    acc = h[:n].copy()
    for j in range(1, k):
        acc = mix(acc * U64(0x9E3779B97F4A7C15) + h[j:j + n])
    at = np.flatnonzero(w.doc[:n] == w.doc[k - 1:])
    return at, acc[at]


def bytes_of(name: str) -> Column:
    """A text column as UTF-8 bytes, which Python then reads without decoding."""
    return F.col(f"`{name}`").cast("string").cast("binary").alias("text")


def set_batches(spark) -> None:
    """Bound the bytes of an Arrow batch, so that a run of very long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    except Exception as e:  # noqa: BLE001 - versions without the setting keep the row bound
        if "maxBytesPerBatch" not in str(e):
            raise


def mapped(df: DataFrame, each, schema: str) -> DataFrame:
    """``mapInArrow`` of a function from a record batch to a record batch or dict of columns."""
    set_batches(df.sparkSession)

    def run(batches):
        for b in batches:
            if b.num_rows:
                out = each(b)
                if out is not None:
                    yield out if isinstance(out, pa.RecordBatch) else pa.RecordBatch.from_pydict(out)
    return df.mapInArrow(run, schema)


def filtered(docs: DataFrame, text_col: str, keep) -> DataFrame:
    """Rows of ``docs`` for which ``keep(text column) -> bool array`` holds, with columns as they are."""
    set_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(keep(b.column(at))))
    return docs.mapInArrow(run, docs.schema)
