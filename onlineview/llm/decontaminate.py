"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all benchmark items.

Texts are normalised to folded words; a window is 13 consecutive words of an item (all of
them, if it has fewer). The automaton runs over word numbers, once over each text, and only
over stretches of benchmark words at least as long as the shortest window, since no window
can lie elsewhere. Hits are mapped back to code points of the original text.

The benchmark reaches the driver in parts of about ``PART_BYTES`` (an item is never split). A larger
one is scanned for in one pass for each part: the part's hits are written, its automaton is given up
before the next part is read, and Spark merges the hits by text. So the driver and the workers hold one
part at a time, whatever the benchmark's size; the time grows with the number of parts.

Defined results: a null or empty text has no words and no hits; an item without words has
no window; a null item_id marks words but is not listed; items that share an id are one;
very long texts are scanned whole; a share of hit words at the limit is contaminated; repeated
rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import staged, unused
from .text import FOLD, PUNCTUATION, U64, Words, blob, bytes_of, chunks, mapped, set_batches

WINDOW = 13
#: A document is contaminated if at least 1 in this many of its words is hit.
ONE_IN = 20
#: Bytes of item texts that one automaton is built from.
PART_BYTES = 1 << 20


class Matcher:
    """Finds the windows of some items in word sequences."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        data = np.frombuffer(b"".join(t for _, t in items), np.uint8)
        offs = np.concatenate(([0], np.cumsum([len(t) for _, t in items], dtype=np.int64)))
        w = Words(FOLD[data], offs, PUNCTUATION)
        self.vocabulary, number = np.unique(w.hash, return_inverse=True)
        self.slots = max(16, 2 * len(self.vocabulary)).bit_length() + 4
        self.table = np.zeros(1 << self.slots, bool)
        self.table[(self.vocabulary >> U64(64 - self.slots)).astype(np.int64)] = True
        self.window, self.windows = window, {}
        for i, (name, _) in enumerate(items):
            words = (number[w.bounds[i]:w.bounds[i + 1]] + 1).tolist()
            size = min(window, len(words))
            for k in range(len(words) - size + 1) if size else ():
                self.windows.setdefault(tuple(words[k:k + size]), set()).add(name)
        self.shortest = min(map(len, self.windows), default=0)
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    @property
    def automaton(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for seq, names in self.windows.items():
                self._automaton.add_word(seq, (len(seq), names))
            self._automaton.make_automaton()
        return self._automaton

    def find(self, w: Words) -> tuple[np.ndarray, list[tuple[int, set]]]:
        """Whether each word of a run of documents is hit, and (document, items) of each occurring window."""
        hit, found = np.zeros(len(w.st), bool), []
        if not self.shortest or not len(w.st):
            return hit, found
        h = w.hash
        known = np.flatnonzero(self.table[(h >> U64(64 - self.slots)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, h[known])
        at[at == len(self.vocabulary)] = 0
        known, at = (x[self.vocabulary[at] == h[known]] for x in (known, at))
        new = np.ones(len(known), bool)
        new[1:] = (np.diff(known) != 1) | (np.diff(w.doc[known]) != 0)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(known)))
        for s, n in zip(starts[sizes >= self.shortest], sizes[sizes >= self.shortest]):
            first = known[s]
            for end, (size, names) in self.automaton.iter(tuple((at[s:s + n] + 1).tolist())):
                hit[first + end - size + 1:first + end + 1] = True
                found.append((int(w.doc[first]), names))
        return hit, found


def _parts(benchmark: DataFrame, part_bytes: int) -> list[DataFrame]:
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), bytes_of("text")).filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text") + 100)).first()[0] or 0
    n = -(-total // part_bytes) or 1
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items for k in range(n)]


def _matcher(spark: SparkSession, part: DataFrame, window: int):
    return spark.sparkContext.broadcast(Matcher([(r.item_id, bytes(r.text)) for r in part.collect()], window))


def _key(text) -> Column:
    return F.sha2(text, 256)  # hits depend on the text alone


def _merged(docs: DataFrame, parts: list[DataFrame], window: int) -> DataFrame:
    """mkey (of a text), hits (word positions, of one part each), found (items) of the texts with hits; one part is held at a time."""
    texts, each_part = docs.select(bytes_of("text")), []
    for part in parts:
        matcher = _matcher(docs.sparkSession, part, window)
        rows = mapped(texts.select(F.lit(None).cast("long").alias("doc_id"), "text"), _marker(matcher), _SCHEMA).filter(F.size("hits") > 0)
        # copies of a text have the same hits
        each_part.append(staged(rows.groupBy(_key("text").alias("mkey")).agg(F.first("hits").alias("hits"), F.first("items").alias("items")), "benchmark-hits"))
        matcher.destroy()
    return (reduce(DataFrame.union, each_part).groupBy("mkey")
            .agg(F.flatten(F.collect_list("hits")).alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("found")))


_SCHEMA = "doc_id long, text binary, hits array<binary>, items array<string>"


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """Every row of ``docs`` (doc_id, text as bytes) with n_words, items found and hit spans.

    ``spans`` are (start, end) in code points of the original text, merged over adjacent hit words;
    ``n_hit`` counts their words.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of("text"))
    parts = _parts(benchmark, part_bytes)
    if len(parts) == 1:
        out = mapped(rows, _marker(_matcher(docs.sparkSession, parts[0], window)), _SCHEMA)
    else:
        merged = _merged(docs, parts, window)
        out = (rows.join(merged, _key(rows["text"]) == merged["mkey"], "left")
               .select("doc_id", "text", "hits", F.coalesce("found", F.array().cast("array<string>")).alias("items")))
    return mapped(out, _counts, "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>")


def _marker(matcher):
    """Each row of (doc_id, text) with the positions of its hit words, if any, and the items found."""
    def each(b):
        data, offs = blob(b.column(1))
        hits, items = [[] for _ in range(b.num_rows)], [set() for _ in range(b.num_rows)]
        for i, j in chunks(offs):
            w = Words(FOLD[data[offs[i]:offs[j]]], offs[i:j + 1] - offs[i], PUNCTUATION)
            hit, found = matcher.value.find(w)
            for d, names in found:
                items[i + d] |= names - {None}
            for d in {d for d, _ in found}:
                hits[i + d] = [np.flatnonzero(hit[w.bounds[d]:w.bounds[d + 1]]).astype(np.int64).tobytes()]
        return {"doc_id": b.column(0), "text": b.column(1), "hits": pa.array(hits, pa.list_(pa.binary())), "items": pa.array([sorted(x) for x in items], pa.list_(pa.string()))}
    return each


def _positions(hits: list[bytes] | None) -> np.ndarray:
    return np.unique(np.frombuffer(b"".join(hits or []), np.int64))


def _counts(b):
    data, offs = blob(b.column(1))
    hits = [_positions(h) for h in b.column(2).to_pylist()]
    n_words, spans = [], []
    for i, j in chunks(offs):
        d = data[offs[i]:offs[j]]
        w = Words(FOLD[d], offs[i:j + 1] - offs[i], PUNCTUATION)
        n_words.append(w.count)
        for k in range(i, j):
            at = hits[k]
            if not len(at):
                spans.append([])
                continue
            cut = np.flatnonzero(np.diff(at) != 1)
            first, last = at[np.append(0, cut + 1)] + w.bounds[k - i], at[np.append(cut, len(at) - 1)] + w.bounds[k - i]
            own = d[w.offs[k - i]:w.offs[k - i + 1]]
            cp = np.concatenate(([0], np.cumsum((own & 0xC0) != 0x80)))
            spans.append([{"start": int(cp[s]), "end": int(cp[e])} for s, e in zip(w.st[first] - w.offs[k - i], w.en[last] - w.offs[k - i])])
    return {"doc_id": b.column(0), "n_words": pa.array(np.concatenate(n_words).astype(np.int64)),
            "n_hit": pa.array([len(h) for h in hits], pa.int64()), "items": b.column(3),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))}


def digest(scanned: DataFrame, one_in: int = ONE_IN) -> DataFrame:
    """The scan's result as counts, a hash of the item ids and the verdict."""
    listed = F.concat_ws(",", F.array_sort("items"))
    return scanned.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = ONE_IN, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows that are not contaminated, columns unchanged."""
    spark, parts = docs.sparkSession, _parts(benchmark, part_bytes)
    matcher = _matcher(spark, parts[0], window) if len(parts) == 1 else None
    at, rows, n = docs.columns.index("text"), docs, len(docs.columns)
    if matcher is None:
        mkey, hits = unused(docs.columns, "mkey"), unused(docs.columns, "hits")
        merged = _merged(docs, parts, window).drop("found").withColumnsRenamed({"mkey": mkey, "hits": hits})
        rows = docs.join(merged, _key(F.col("text").cast("string").cast("binary")) == F.col(mkey), "left").drop(mkey)
    set_batches(spark)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            data, offs = blob(b.column(at).cast(pa.binary()))
            keep = np.ones(b.num_rows, bool)
            for i, j in chunks(offs):
                w = Words(FOLD[data[offs[i]:offs[j]]], offs[i:j + 1] - offs[i], PUNCTUATION)
                if matcher is None:
                    n_hit = np.array([len(_positions(h)) for h in b.column(n).slice(i, j - i).to_pylist()], np.int64)
                else:
                    hit = matcher.value.find(w)[0]
                    n_hit = np.add.reduceat(np.append(hit, False).astype(np.int64), w.bounds[:-1]) * (w.count > 0)
                keep[i:j] = ~((n_hit > 0) & (one_in * n_hit >= w.count))
            yield b.select(list(range(n))).filter(pa.array(keep))
    return rows.mapInArrow(run, docs.schema)
