"""Packing along a space-filling curve.

Each document's token ids are hashed to a few random directions; the unit vector's
coordinates give a cell of a Hilbert curve. Documents are put in order of that key
by a range sort of thin rows and laid end to end; the stream is cut every 1024 ids.
What is left at the end is cut into powers of two, so no sequence is padded.

Token ids are made once and written to the shared folder; only row numbers, keys and
lengths are sorted. The driver sees one total per range part.

Defined results: a null text is empty and packs as the end id alone; ties of the key
are broken by row number; repeated rows are packed each; a very long text is cut over as many sequences
as it fills; other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import staged
from .text import mapped, mix

SEQUENCE = 1024
END_ID = 0
DIMENSIONS = 3
CELL_BITS = 10
#: About how many words' ids a worker remembers.
REMEMBERED = 400_000


def default_tokenizer() -> tuple[str, str]:
    """Vocabulary file, and the same vocabulary as a rank file."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class ByteBpe:
    """Ids of whole texts by a byte-level BPE file, with common words remembered.

    A text without white space beside a space or at its ends splits into words at its
    spaces, and the BPE never merges over such a split, so ids of words can be joined. Other
    texts, texts that hold the literal of an added token, which becomes that token's id, and
    words with unusual characters go to the tokenizer as they are. Plain words
    use the rank file of the same vocabulary, which gives the same ids faster, all new words
    of a text in one call.
    """

    _plain = re.compile("[ \n!-~\xa1-ɏ]+").fullmatch

    def __init__(self, vocabulary: str, ranks: str | None):
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(vocabulary)
        self.full.no_truncation()
        specials = [re.escape(t.content) for t in self.full.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(specials)).search if specials else lambda text: None
        self.code = "H" if self.full.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        self.words: dict[str, bytes] = {}
        self.ranks = None
        if ranks:
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranks = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
            self.opens = np.zeros(max(table.values()) + 1, bool)  # ids whose bytes begin with a space
            self.opens[[i for token, i in table.items() if token[:1] == b" "]] = True

    def ids(self, text: str) -> bytes:
        return array(self.code, self.full.encode(text, add_special_tokens=False).ids).tobytes()

    def new_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, each with the space before it; plain ones in one call, cut at ids that begin with a space."""
        plain = []
        if self.ranks is not None:
            plain = words if self._plain(" ".join(words)) else [w for w in words if self._plain(w)]
        out = {}
        if plain:
            ids = np.array(self.ranks.encode_ordinary(" " + " ".join(plain)), self.dtype)
            raw = ids.tobytes()
            cut = (np.append(np.flatnonzero(self.opens[ids]), len(ids)) * self.dtype.itemsize).tolist()
            out = {w: raw[i:j] for w, i, j in zip(plain, cut[:-1], cut[1:], strict=True)}  # raises if the rank file cuts words otherwise
        return out | {w: self.ids(" " + w) for w in words if w not in out}

    def encode(self, text: str) -> bytes:
        head, *rest = text.split(" ")
        if _loose(head) or self._special(text):
            return self.ids(text)
        found = list(map(self.words.get, rest))
        if None in found:
            words = list({w for w, ids in zip(rest, found) if ids is None})
            if any(map(_loose, words)):
                return self.ids(text)
            new = self.new_words(words)
            found = [new[w] if ids is None else ids for w, ids in zip(rest, found)]
            if len(self.words) < REMEMBERED:
                self.words.update((w, ids) for w, ids in new.items() if len(w) < 64)
        return self.ids(head) + b"".join(found)


def _loose(word: str) -> bool:
    """Empty, or white space at an end: such words do not stand alone beside a space."""
    return not word or word[0].isspace() or word[-1].isspace()


_LOADED: dict[tuple, ByteBpe] = {}


def tokenizer(files: tuple[str, str | None]) -> ByteBpe:
    """The tokenizer of these files, loaded once in each Python worker."""
    if files not in _LOADED:
        _LOADED[files] = ByteBpe(*files)
    return _LOADED[files]


def directions(size: int, dims: int = DIMENSIONS) -> np.ndarray:
    """A random vector for each token id, from a hash of the id; rarer (higher) ids weigh more."""
    bits = mix(np.arange(size * dims, dtype=np.uint64)).reshape(size, dims)
    unit = bits.astype(np.float64) / 2.0**63 - 1.0
    return (unit * np.log2(2.0 + np.arange(size))[:, None]).astype(np.float32)


def hilbert(cells: np.ndarray, bits: int = CELL_BITS) -> np.ndarray:
    """Position along the Hilbert curve of integer cells (one row each, ``bits`` bits a coordinate).

    Gray-code walk from the highest bit: each level swaps or inverts the lower bits, then the
    coordinates' bits are interleaved.
    """
    x = [cells[:, k].astype(np.int64).copy() for k in range(cells.shape[1])]
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for k in range(n):
            on = (x[k] >> b) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[k] = x[k] ^ swap
    for k in range(1, n):
        x[k] ^= x[k - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[n - 1] >> b) & 1 == 1, flip ^ ((1 << b) - 1), flip)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for k in range(n):
            key = (key << 1) | (((x[k] ^ flip) >> b) & 1)
    return key


def curve_key(ids: list[np.ndarray], table: np.ndarray, bits: int = CELL_BITS) -> np.ndarray:
    """Hilbert key of each document's direction (its tokens' vectors added up)."""
    v = np.stack([table[i].sum(0) for i in ids]).astype(np.float64)
    size = np.linalg.norm(v, axis=1, keepdims=True)
    unit = np.divide(v, size, out=np.zeros_like(v), where=size > 0)
    return hilbert(np.clip(((unit + 1) * (1 << (bits - 1))).astype(np.int64), 0, (1 << bits) - 1), bits)


def tokenised(docs: DataFrame, files: tuple[str, str | None]) -> DataFrame:
    """rid, doc_id, n (ids with the end id), key, ids (little-endian), written once."""
    def each(b):
        bpe = tokenizer(files)
        table = _table(bpe.full.get_vocab_size())
        end = array(bpe.code, [END_ID]).tobytes()
        ids = [bpe.encode(t) + end if t else end for t in b.column(1).to_pylist()]
        arrays = [np.frombuffer(i, bpe.dtype) for i in ids]
        return {"doc_id": b.column(0), "n": pa.array([len(a) for a in arrays], pa.int64()),
                "key": pa.array(curve_key(arrays, table)), "ids": pa.array(ids, pa.binary())}

    out = mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")), each, "doc_id long, n long, key long, ids binary")
    return staged(out.select(F.monotonically_increasing_id().alias("rid"), "*"), "packing-ids")


_TABLES: dict[int, np.ndarray] = {}


def _table(size: int) -> np.ndarray:
    if size not in _TABLES:
        _TABLES[size] = directions(size)
    return _TABLES[size]


def _running(batches):
    """rid, part, start: ids before each row in its part, rows in the order given."""
    part, total = TaskContext.get().partitionId(), 0
    for b in batches:
        n = b.column(1).to_numpy()
        sums = np.cumsum(n)
        yield pa.RecordBatch.from_pydict({"rid": b.column(0), "part": pa.array(np.full(len(n), part, np.int32)),
                                          "start": pa.array(total + sums - n), "after": pa.array(total + sums)})
        total += int(sums[-1]) if len(n) else 0


def cuts(total: int, length: int = SEQUENCE) -> np.ndarray:
    """Ends of the sequences after the last full one: what is left of ``total`` in powers of two."""
    full, rest = total // length * length, total % length
    ends = []
    for b in reversed(range(rest.bit_length())):
        if rest >> b & 1:
            full += 1 << b
            ends.append(full)
    return np.array(ends, np.int64)


def pack(docs: DataFrame, files: tuple[str, str | None] | None = None, length: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its ids on demand."""
    fat = tokenised(docs, files or default_tokenizer())
    dtype = tokenizer(files or default_tokenizer()).dtype
    thin = fat.select("rid", "n", "key").repartitionByRange("key", "rid").sortWithinPartitions("key", "rid").select("rid", "n")
    placed = staged(thin.mapInArrow(_running, "rid long, part int, start long, after long"), "packing-order")
    bases, total = [], 0
    for r in placed.groupBy("part").agg(F.max("after").alias("n")).orderBy("part").collect():
        bases.append((r.part, total))
        total += r.n
    base = docs.sparkSession.createDataFrame(bases, "part int, base long")  # one row for each range part
    at = placed.join(F.broadcast(base), "part").select("rid", (F.col("start") + F.col("base")).alias("at"))
    tail, full = cuts(total, length), total // length

    def each(b):
        cols = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
        parts = []
        for doc, at, n, raw in zip(*(b.column(k).to_pylist() for k in range(4))):
            ids = np.frombuffer(raw, dtype).astype("<u4").tobytes()
            pos = 0
            while pos < n:
                g = at + pos
                if g < full * length:
                    seq, off = divmod(g, length)
                    size = min(length - off, n - pos)
                else:
                    k = int(np.searchsorted(tail, g, "right"))
                    first = int(tail[k - 1]) if k else full * length
                    seq, off, size = full + k, g - first, min(int(tail[k]) - g, n - pos)
                piece = ids[4 * pos:4 * (pos + size)]
                for name, v in zip(cols, (doc, pos, size, zlib.crc32(piece), n, seq, off)):
                    cols[name].append(v)
                if with_ids:
                    parts.append(np.frombuffer(piece, "<u4").astype(np.int32))
                pos += size
        out = {k: pa.array(v, pa.int64()) for k, v in cols.items()}
        return out | ({"ids": pa.array(parts, pa.list_(pa.int32()))} if with_ids else {})

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids array<int>" if with_ids else "")
    return mapped(fat.join(at, "rid").select("doc_id", "at", "n", "ids"), each, schema)
