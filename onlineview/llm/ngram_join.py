"""N-gram Jaccard join over size-banded tiles with bitmap signatures; linked groups of documents.

Two documents link if the Jaccard similarity of their word-shingle sets is at least
num / den. All links between different sets are found, without comparing all pairs:

1. Equal sets are one class; only classes go on.
2. Sizes fall into bands so wide that linked classes lie in one band or two that touch. A
   tile is a band with the part of the next that can link into it. Linked sets of a tile differ in at
   most D shingles, so of more than D hash ranges with shingles at least one holds the same in both. A tile
   has as many ranges as its smallest sets need to fill more than D of them.
   Each class gives one key per range and tile; classes that share a key are candidates.
3. In each key's group, members are compared with the member that shares most keys with others
   (a star, not all pairs). The popcount of the XOR of two bitmaps is at most the size of the
   difference of the sets, so it bounds the overlap from above; only for pairs that survive that
   bound are sets fetched, which exact intersection of sorted arrays then decides.
4. Links give components. Groups that still hold several components are compared block
   by block across components, again first by bitmaps and then exactly: once the closest
   pairs, which join most, and then all that is left, so no link is lost.

Keys, pairs and labels are tables that Spark shuffles; hot groups spread over blocks. Nothing
but counts reaches the driver.

Defined results: a null or empty text has an empty set and is linked with nothing; a text
shorter than a shingle is one shingle; null ids are linked like others but never name a
component unless all its ids are null; repeated rows are equal documents; a similarity at
the threshold links; very long texts are taken whole, one at a time; an empty table gives
an empty result.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import narrowed, staged, unused
from .text import FOLD, U64, Words, blob, bytes_of, chunks, mapped, mix, mix_int, windows

#: Bits of a bitmap, by size of the set: about as many as shingles, within these bounds.
MIN_BITS, MAX_BITS = 64, 8192
#: Members of a block in the comparison of what the stars left over.
BLOCK = 256
#: Bitmaps compared at a time.
COMPARED = 8192
BANDS_TO = 1 << 40


class Tiles:
    """Size bands for a similarity of num / den, and how many hash ranges each tile has."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.starts = [1]
        while self.starts[-1] < BANDS_TO:  # two factors of den / num wide: about half of a band links into the one below
            a = self.starts[-1]
            self.starts.append(max(a + 1, a * den**2 // num**2))
        self.ranges = [self._count(b) for b in range(len(self.starts) - 1)]  # counted once, so all workers agree

    def partner(self, size: int) -> int:
        """The largest set that one of this size can link with."""
        return size * self.den // self.num

    def band(self, size: int) -> int:
        return bisect.bisect_right(self.starts, size) - 1

    def top(self, band: int) -> int:
        return self.starts[band + 1] - 1

    def differences(self, band: int) -> int:
        """Most shingles in which two linked sets of the tile differ: |A xor B| <= (|A| + |B|)(den - num) / (den + num)."""
        t = self.top(band)
        return (t + self.partner(t)) * (self.den - self.num) // (self.den + self.num)

    def _count(self, band: int) -> int:
        """Ranges of a tile: from D + 2 up, as many as leave more than D filled by its smallest sets, four deviations apart.

        At most twice D + 2, where the smallest tiles stop.
        """
        d, n = self.differences(band), self.starts[band]
        k, most = d + 2, 2 * (d + 2)
        while k < most:
            empty = math.exp(-n / k)
            if k * (1 - empty) - 4 * math.sqrt(k * empty * max(0.0, 1 - (1 + n / k) * empty)) > d:
                break
            k = min(most, k + max(1, k // 64))
        return k

    def of(self, size: int) -> list[int]:
        """The tiles a set of this size belongs to."""
        b = self.band(size)
        return [b] if not b or self.partner(self.top(b - 1)) < size else [b, b - 1]


def _bits(size: int) -> int:
    return min(MAX_BITS, max(MIN_BITS, 1 << (size - 1).bit_length()))


def bitmap(s: np.ndarray) -> np.ndarray:
    """XOR bitmap of a set as 64-bit words; the half-size bitmap is the XOR of its halves."""
    bits = _bits(len(s))
    at = (mix(s ^ U64(0x5851F42D4C957F2D)) & U64(bits - 1)).astype(np.int64)
    on = np.bincount(at, minlength=bits) & 1
    return np.packbits(on.astype(np.uint8), bitorder="little").view(U64)


def keys_of(s: np.ndarray, tiles: Tiles) -> np.ndarray:
    """One key for each tile and hash range of a sorted set.

    Empty ranges are left out as long as more ranges than differences hold something: then
    some range with shingles is still the same in both sets of any link. The few sets that
    fill fewer put out their empty ranges too.
    """
    out = []
    for tile in tiles.of(len(s)):
        d = tiles.differences(tile)
        if d == 0:
            continue  # only equal sets link
        k = tiles.ranges[tile]
        step = (1 << 64) // k
        cut = np.searchsorted(s, np.arange(1, k, dtype=U64) * U64(step))
        cut = np.concatenate(([0], cut, [len(s)]))
        total = np.zeros(len(s) + 1, U64)
        np.cumsum(mix(s ^ U64(0xD6E8FEB86659FD93)), out=total[1:])
        salt = U64(mix_int(tile * 0x9E3779B97F4A7C15 + 1))
        key = mix(mix((total[cut[1:]] - total[cut[:-1]]) ^ salt) + np.arange(k, dtype=U64) * U64(0xC2B2AE3D27D4EB4F))
        full = np.diff(cut) > 0
        out.append(key[full] if full.sum() > d else key)
    return np.concatenate([np.zeros(0, U64), *out])


def shingle_sets(texts: pa.Array, k: int):
    """The sorted distinct shingle hashes of each text."""
    data, offs = blob(texts)
    for i, j in chunks(offs):
        w = Words(FOLD[data[offs[i]:offs[j]]], offs[i:j + 1] - offs[i])
        h = w.hash
        at, sh = windows(w, h, k)
        cut = np.searchsorted(at, w.bounds)
        for d in range(j - i):
            if w.count[d] >= k:
                yield np.unique(sh[cut[d]:cut[d + 1]])
            elif w.count[d]:
                acc = mix_int(int(w.count[d]))
                for x in h[w.bounds[d]:w.bounds[d + 1]]:
                    acc = mix_int((acc * 0x9E3779B97F4A7C15 + int(x)))
                yield np.array([acc], U64)
            else:
                yield np.zeros(0, U64)


def _class(s: np.ndarray) -> int:
    """64-bit identity of a set, as a signed number."""
    if not len(s):
        return 0
    a = int(np.sum(mix(s), dtype=U64)) ^ mix_int(len(s))
    return int(np.array([mix_int(a)], U64).view(np.int64)[0])


def documents(docs: DataFrame, k: int, tiles: Tiles) -> DataFrame:
    """doc_id, tkey (hash of the text), n (set size), cls, bits (bitmap), keys for every row, written once.

    Shingles are made here and, for the classes of pairs that the bitmaps allow, in ``class_sets``; nowhere
    else. A task gives the keys of a class once (null in its other rows), so copies add no keys.
    """
    seen = set()  # each task has its own copy

    def each(b):
        n, cls, bits, keys = [], [], [], []
        for s in shingle_sets(b.column(2), k):
            c = _class(s)
            new = len(s) > 0 and c not in seen
            if new:
                seen.add(c)
            n.append(len(s))
            cls.append(c)
            bits.append(bitmap(s).tobytes() if len(s) else None)
            keys.append(keys_of(s, tiles).view(np.int64) if new else None)
        return {"doc_id": b.column(0), "tkey": b.column(1), "n": pa.array(n, pa.int64()), "cls": pa.array(cls, pa.int64()),
                "bits": pa.array(bits, pa.binary()), "keys": pa.array(keys, pa.list_(pa.int64()))}

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"), bytes_of("text"))
    return staged(mapped(src, each, "doc_id long, tkey long, n long, cls long, bits binary, keys array<long>"), "ngram-docs")


def class_table(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """cls, n, bits and one of its documents (doc_id, tkey) for every class that shares a key, written once."""
    return staged(rows.join(keys.select("cls").distinct(), "cls", "left_semi")
                  .groupBy("cls").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.min(F.struct("doc_id", "tkey")).alias("r"))
                  .select("cls", "n", "bits", "r.doc_id", "r.tkey"), "ngram-classes")


def shared_keys(rows: DataFrame) -> DataFrame:
    """key, cls for keys that at least two classes have, written once.

    Keys are counted by partial minima and maxima and then joined back to the rows, so no group
    of a key has to lie in one task. Most keys are of one class; bitmaps keep them out of the second shuffle.
    """
    all_keys = rows.select(F.explode("keys").alias("key"), "cls")
    shared = staged(all_keys.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select("key"), "ngram-shared")
    return staged(narrowed(all_keys, ["key"], shared).join(shared, "key", "left_semi").repartition("key", "cls").distinct(), "ngram-keys")


def class_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """cls, items (sorted 64-bit hashes) of the classes in ``pairs``, made from one of their documents; written once.

    Only texts whose id and hash may be wanted are shuffled.
    """
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    one = staged(classes.join(wanted, "cls", "left_semi").select("cls", "doc_id", "tkey"), "ngram-wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("d"), F.xxhash64("text").alias("t"), bytes_of("text"))
    found = narrowed(texts, ["d", "t"], one.select("doc_id", "tkey")).join(one, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("tkey"))).select("cls", "text")

    def each(b):
        return {"cls": b.column(0), "items": pa.array([s.tobytes() for s in shingle_sets(b.column(1), k)], pa.binary())}

    # repeated rows give a class twice
    return staged(mapped(found, each, "cls long, items binary").groupBy("cls").agg(F.first("items").alias("items")), "ngram-sets")


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    while len(bits) > width:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def may_link(n1, n2, differ, tiles: Tiles):
    """Whether sets of these sizes whose bitmaps differ in so many bits can link (works on arrays)."""
    most = (n1 + n2 - differ) // 2  # bound of the overlap
    return tiles.den * most >= tiles.num * (n1 + n2 - most)


def differing(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """In how many bits each two bitmaps differ, at the width of the smaller."""
    width = np.minimum([len(r) // 8 for r in x], [len(r) // 8 for r in y])
    out = np.zeros(len(x), np.int64)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        p, q = (np.stack([_fold(np.frombuffer(side[i], U64), int(w)) for i in at]) for side in (x, y))
        out[at] = np.bitwise_count(p ^ q).sum(1)
    return out


def plausible(pairs: DataFrame, classes: DataFrame, tiles: Tiles) -> DataFrame:
    """The pairs (a, b) of classes that their sizes and bitmaps allow to link; no set is needed for this."""
    def side(c):
        return classes.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))

    def each(b):
        n1, n2 = b.column(2).to_numpy(), b.column(3).to_numpy()
        ok = may_link(n1, n2, differing(b.column(4).to_pylist(), b.column(5).to_pylist()), tiles)
        return b.select([0, 1]).filter(pa.array(ok))

    return mapped(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b"), each, "a long, b long")


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, tiles: Tiles, name: str) -> DataFrame:
    """The pairs (a, b) of classes that link, by exact intersection of sorted arrays; written once."""
    sets = class_sets(docs, classes, pairs, k)

    def each(b):
        keep = np.zeros(b.num_rows, bool)
        for i, (x, y) in enumerate(zip(b.column(2), b.column(3))):
            x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = tiles.den * both >= tiles.num * (len(x) + len(y) - both)
        return b.select([0, 1]).filter(pa.array(keep))

    a, b = (sets.select(F.col("cls").alias(c), F.col("items").alias(f"items_{c}")) for c in "ab")
    return staged(mapped(pairs.join(a, "a").join(b, "b").select("a", "b", "items_a", "items_b"), each, "a long, b long"), name)


def stars(keys: DataFrame) -> DataFrame:
    """For every class the one pair with the member of its groups that shares most keys with others."""
    rank = keys.groupBy("cls").agg(F.count(F.lit(1)).alias("shared"))
    ranked = keys.join(rank, "cls")
    top = ranked.groupBy("key").agg(F.max(F.struct("shared", "cls")).alias("top"))
    best = ranked.join(top, "key").groupBy("cls").agg(F.max("top").alias("top"))
    return best.select(F.col("cls").alias("a"), F.col("top.cls").alias("b")).filter("a <> b")


def components(links: DataFrame) -> DataFrame:
    """cls, comp for every class with a link; comp is the smallest class reachable.

    Every round takes the smallest label among neighbours and then the label's own label, so
    chains shorten geometrically. Rounds are written to the shared folder.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "ngram-links")
    labels = staged(both.groupBy(F.col("a").alias("cls")).agg(F.min("b").alias("m")).select("cls", F.least("cls", "m").alias("comp")), "ngram-labels")
    while True:
        near = (both.join(labels.select(F.col("cls").alias("b"), "comp"), "b").groupBy(F.col("a").alias("cls")).agg(F.min("comp").alias("m")))
        step = labels.join(near, "cls").select("cls", F.least("comp", "m").alias("comp"), F.col("comp").alias("old"))
        hop = labels.select(F.col("cls").alias("comp"), F.col("comp").alias("next"))
        new = staged(step.join(hop, "comp").select("cls", F.least("comp", "next").alias("comp"), "old"), "ngram-labels")
        labels = new.select("cls", "comp")
        if new.filter("comp <> old").isEmpty():
            return labels


def leftovers(keys: DataFrame, labels: DataFrame, classes: DataFrame, tiles: Tiles, closest: bool) -> DataFrame:
    """Pairs of different components that share a key and pass the bitmap bound.

    With ``closest`` only the pair of most similar bitmaps for each two components of a unit: enough to join
    components that have many links between them, but not to find all links.

    Groups with the same members are compared once. A group is cut into blocks of about
    ``BLOCK`` members by hash; each pair of blocks is one unit of work, whose comparisons
    are array operations and of which only what passes is put out.
    """
    comp = keys.join(labels, "cls", "left").select("key", "cls", F.coalesce("comp", "cls").alias("comp"))
    group = (comp.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                     F.sum(F.xxhash64("cls").cast("decimal(20,0)")).alias("members"))
             .filter("lo < hi").groupBy("size", "members", "lo", "hi").agg(F.min("key").alias("key")))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = comp.join(group.select("key", blocks.alias("blocks")), "key").withColumn("p", F.pmod(F.hash("cls"), F.col("blocks")))
    dealt = mine.join(classes.select("cls", "n", "bits"), "cls").withColumn("q", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = ["key", "i", "j"]
    dealt = (dealt.select("key", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), F.col("p").alias("own"), "cls", "comp", "n", "bits")
             .repartition(*unit).sortWithinPartitions(*unit))

    def pairs(t: pa.Table, cut: np.ndarray):
        """Rows x < y of one unit whose components, blocks, sizes and bitmaps allow a link, for all units at once."""
        comp, n, own, i, j = (t.column(c).to_numpy() for c in ("comp", "n", "own", "i", "j"))
        raw = t.column("bits").to_pylist()
        words = np.array([len(r) // 8 for r in raw])
        tables: dict[int, np.ndarray] = {}

        def table(w: int) -> np.ndarray:  # bitmaps at one width; rows with narrower ones stay 0 and are not asked for
            if w not in tables:
                tables[w] = np.zeros((len(raw), w), U64)
                for r in np.flatnonzero(words >= w):
                    tables[w][r] = _fold(np.frombuffer(raw[r], U64), w)
            return tables[w]

        sizes = np.diff(cut)
        left = np.repeat(cut[1:], sizes) - np.arange(cut[-1]) - 1  # rows of the unit after each row
        for step in range(1, int(sizes.max(initial=1))):
            x = np.flatnonzero(left >= step)
            y = x + step
            ok = (comp[x] != comp[y]) & ((i[x] == j[x]) | (own[x] != own[y])) & may_link(n[x], n[y], np.abs(n[x] - n[y]), tiles)
            x, y = x[ok], y[ok]
            width = np.minimum(words[x], words[y])
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                bits = table(int(w))
                for lo in range(0, len(at), COMPARED):  # bounded memory for wide bitmaps
                    p, q = x[at[lo:lo + COMPARED]], y[at[lo:lo + COMPARED]]
                    differ = np.bitwise_count(bits[p] ^ bits[q]).sum(1).astype(np.int64)
                    keep = may_link(n[p], n[q], differ, tiles)
                    if keep.any():
                        yield p[keep], q[keep], differ[keep] / (n[p[keep]] + n[q[keep]])

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]) if held is not None else t
            held = yield from units(t, last=False)
        if held is not None:
            yield from units(held, last=True)

    def units(t, last):
        cols = [t.column(c).to_numpy() for c in unit]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1 if len(t) > 1 else np.zeros(0, int)
        cut = np.concatenate(([0], new, [len(t)]))
        if not last:
            cut = cut[:-1]  # the last unit may go on in the next batch
        whole = t.slice(0, cut[-1])
        cls = whole.column("cls").to_numpy()

        def batch(x, y):
            return pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(cls[x], cls[y])), "b": pa.array(np.maximum(cls[x], cls[y]))})

        found = pairs(whole, cut) if len(whole) else iter(())
        if not closest:
            for x, y, _ in found:
                yield batch(x, y)
        elif found := [(x, y, far) for x, y, far in found]:
            x, y, far = (np.concatenate(c) for c in zip(*found))
            comp = whole.column("comp").to_numpy()
            key = [np.searchsorted(cut, x, "right"), np.minimum(comp[x], comp[y]), np.maximum(comp[x], comp[y])]
            order = np.lexsort((far, *key))
            first = np.ones(len(order), bool)
            first[1:] = np.any([k[order][1:] != k[order][:-1] for k in key], axis=0)
            yield batch(x[order[first]], y[order[first]])
        return t.slice(cut[-1]) if cut[-1] < len(t) else None

    return dealt.mapInArrow(run, "a long, b long").distinct()


def linked(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): doc_id, tkey, n, cls for every document, and cls, comp for classes that link with others."""
    tiles = Tiles(num, den)
    rows = documents(docs, k, tiles)
    keys = shared_keys(rows)
    classes = class_table(rows, keys)
    pairs = staged(plausible(stars(keys), classes, tiles), "ngram-pairs")
    links = verified(docs, classes, pairs, k, tiles, "ngram-stars")
    labels = components(links)
    tried = None
    # components that have many links between them are joined by their closest pairs before all pairs are looked at
    for closest in (True, False):
        rest = leftovers(keys, labels, classes, tiles, closest)
        rest = staged(rest if tried is None else rest.join(tried, ["a", "b"], "left_anti"), "ngram-rest")
        if rest.isEmpty():
            break
        links = links.union(verified(docs, classes, rest, k, tiles, "ngram-more"))
        labels, tried = components(links), rest
    return rows, labels


def join(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, cls, component_id for every row."""
    rows, labels = linked(docs, k, num, den)
    own = rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    groups = labels.join(own, "cls")
    whole = groups.join(groups.groupBy("comp").agg(F.min("least").alias("all")), "comp").select("cls", "all")
    ids = own.join(whole, "cls", "left").select("cls", F.coalesce("all", "least").alias("component_id"))
    return (rows.join(ids, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), "cls", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each group of linked documents (the smallest id), columns unchanged; unlinked rows stay."""
    rows, labels = linked(docs, k, num, den)
    own = rows.filter("n > 0").join(labels, "cls", "left").select("doc_id", "tkey", F.coalesce("comp", "cls").alias("comp"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "tkey")
    first = own.groupBy("comp").agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    d, t = unused(docs.columns, "gone_id"), unused(docs.columns, "gone_text")
    gone = (own.join(first, "comp").filter(~(F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("tkey") == F.col("f.tkey"))))
            .select(F.col("doc_id").alias(d), F.col("tkey").alias(t)).distinct())
    match = F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(t))
    kept = docs.join(gone, match, "left_anti")
    again = staged(own.groupBy("doc_id", "tkey").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
                   .select(F.col("doc_id").alias(d), F.col("tkey").alias(t)), "ngram-repeats")
    if again.isEmpty():
        return kept
    # of rows with one id and text the least stays, by all columns that have an order
    columns = [F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, T.MapType)]
    one = kept.join(again, match, "left_semi").groupBy(F.col("doc_id").alias(d), F.col("text").alias(t)).agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.struct(*columns)).alias("row"))
    return kept.join(again, match, "left_anti").unionByName(one.select("row.*"))
