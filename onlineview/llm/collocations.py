"""Phrase collocations: counts of all phrases of 2 to 5 words by multikey quicksort of suffix pointers.

Every word position of a text starts a suffix, cut at its piece's end, at five words, and before the first
pair of words that is too rare for any frequent phrase (pairs are counted in hash buckets over the whole corpus). Suffixes are routed over the whole corpus by
their leading words and equal ones of a batch travel as one with a weight. A task then holds all
suffixes of its leads and sorts pointers to them, one word at a time, in three ways around a pivot:
partitions below and above it go on at the same word, the equal one has found a phrase, whose count is its
weight, and goes on at the next word until the depth is reached. Partitions lighter than the least count
are abandoned. All partitions of a task are split in the same numpy steps, so small ones cost no call of their own.

Leads whose suffixes would fill a task (a word pair in a third of all texts) are routed by one more
word, and so on to the full depth, at which equal suffixes have been merged; the counts of their shorter phrases travel
as weights. Which leads are heavy is counted over all suffixes; that decides only where work
is done, never what is counted.

Scores are exact: products are 38-digit decimals. Defined results: a null text has no words and a null
language is `und`; repeated rows count as often as they stand; ties end with the phrase in byte order; a
very long text is read whole, 8 MB of documents at a time (a longer one alone); other columns are
never read; an empty table, or one without frequent phrases, gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import staged
from .text import FOLD, U64, Words, blob, bytes_of, chunks, mix, set_batches

DEPTH = 5
MIN_COUNT = 100
TOP = 2000
UNKNOWN = "und"
#: Suffixes a task sorts, on average; a lead with more than an eighth of that is routed by one more word.
TASK_SUFFIXES = 1 << 20
#: Leads are weighed in 2^LEAD_BITS buckets for each length.
LEAD_BITS = 16
#: Word pairs are counted in a bucket for about 16 words of the corpus, 2^PAIR_BITS (16 MB of marks to broadcast) at most.
#: A pair whose bucket is light is in no frequent phrase; pairs that share a bucket are only kept longer.
PAIR_BITS = 24
SLICE = 1 << 16
#: Bytes of documents taken at once (a longer document alone).
RUN_BYTES = 8 << 20
#: Copies of the count table, over which equal parts of very many phrases are spread when they look up their counts.
SALTS = 8

#: Stands for the end of a suffix among the numbers of its words.
END = (1 << 32) - 1
#: Ends of pieces, and what stands between words of a piece.
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
GAP = BREAK.copy()
GAP[[0x20, 0x09]] = True


class Suffixes:
    """Words of a run of documents: ``ids`` into ``words``, ``lang`` into ``langs``, ``same`` (the next word is in the same piece)."""

    def __init__(self, langs: pa.Array, data: np.ndarray, offs: np.ndarray):
        data = FOLD[data]
        w = Words(data, offs, GAP)
        ends = np.zeros(len(data) + 1, np.int64)
        np.cumsum(BREAK[data], out=ends[1:])
        self.same = np.zeros(len(w.st), bool)
        self.same[:-1] = (ends[w.en[:-1]] == ends[w.st[1:]]) & (w.doc[:-1] == w.doc[1:])
        at = np.concatenate(([0], np.cumsum(w.en - w.st, dtype=np.int64)))
        bare = pa.Array.from_buffers(pa.large_binary(), len(w.st), [None, pa.py_buffer(at), pa.py_buffer(data[~GAP[data]])])
        coded, tags = bare.dictionary_encode(), langs.dictionary_encode()
        self.words, self.ids = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self.langs, self.lang = tags.dictionary.to_pylist(), tags.indices.to_numpy()[w.doc]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lang, word, count) of the distinct words."""
        key, n = np.unique(self.lang.astype(np.int64) * max(len(self.words), 1) + self.ids, return_counts=True)
        return key // max(len(self.words), 1), key % max(len(self.words), 1), n


def _runs(batch):
    """Suffixes of each run of documents of a batch of (lang, text bytes)."""
    langs = batch.column(0)
    data, offs = blob(batch.column(1))
    for i, j in chunks(offs, RUN_BYTES):
        yield Suffixes(langs.slice(i, j - i), data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n over all texts, written once."""
    set_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            for s in _runs(b):
                lang, word, n = s.pairs()
                if len(n):
                    yield pa.RecordBatch.from_pydict({"lang": pa.array(s.langs, pa.string()).take(pa.array(lang)),
                                                      "word": pa.array(s.words, pa.binary()).take(pa.array(word)), "n": pa.array(n, pa.int64())})
    found = _texts(docs).mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return staged(found, "collocation-words")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), bytes_of("text")).filter("text IS NOT NULL")


class Windows:
    """Suffixes of a run that can hold a frequent phrase: ``at`` (their first word), ``size`` (words), ``lead[d]`` (hash of the
    first d words). ``often`` tells by the hash of a pair whether it may be frequent; without it every pair is kept."""

    def __init__(self, s: Suffixes, depth: int, often=None):
        n = len(s.ids)
        digest = lambda xs: np.array([xxhash.xxh3_64_intdigest(x) for x in xs], U64)
        tag, h = digest([x.encode() for x in s.langs])[s.lang], digest(s.words)[s.ids]
        lead = mix(tag * U64(0x9E3779B97F4A7C15) + h)
        nxt = np.roll(h, -1)
        pair = mix(lead * U64(0x9E3779B97F4A7C15) + nxt)
        go = s.same if often is None else s.same & often(pair)
        size = np.ones(n, np.int8)
        alive = go.copy()
        for k in range(1, depth):
            size += alive
            alive[:n - k] &= go[k:]
            alive[max(n - k, 0):] = False
        self.at = np.flatnonzero(size > 1)
        self.size = size[self.at]
        self.lead = {1: lead[self.at], 2: pair[self.at]}
        for d in range(3, depth + 1):
            more = h[np.minimum(self.at + d - 1, max(n - 1, 0))]
            self.lead[d] = np.where(self.size >= d, mix(self.lead[d - 1] * U64(0x9E3779B97F4A7C15) + more), self.lead[d - 1])


def _top(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U64(64 - bits)).astype(np.int64)


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, size: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, size * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


def bucket_counts(docs: DataFrame, depth: int, pair_bits: int) -> DataFrame:
    """d, slice, data (SLICE counts, compressed): suffixes by hash of their first d words (d > 2: LEAD_BITS bits, 2: ``pair_bits``), over all texts."""
    bits = {d: pair_bits if d == 2 else LEAD_BITS for d in range(2, depth + 1)}
    schema = "d int, slice int, data binary"

    def rows(total: dict) -> pa.RecordBatch:
        keys = sorted(total)
        return pa.RecordBatch.from_pydict({"d": pa.array([k[0] for k in keys], pa.int32()), "slice": pa.array([k[1] for k in keys], pa.int32()),
                                           "data": pa.array([_pack(total[k]) for k in keys], pa.binary())})

    def count(batches):
        total = {d: np.zeros(1 << b, np.int64 if d > 2 else np.uint32) for d, b in bits.items()}
        for b in batches:
            for s in _runs(b):
                w = Windows(s, depth)
                for d in bits:
                    np.add.at(total[d], _top(w.lead[d][w.size >= d], bits[d]), total[d].dtype.type(1))
        for d, t in total.items():
            for k in range(0, len(t), SLICE):
                if t[k:k + SLICE].any():
                    yield rows({(d, k // SLICE): t[k:k + SLICE].astype(np.int64)})

    def add(batches):
        total = {}
        for b in batches:
            for d, k, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                got = _unpack(data, SLICE, np.int64)
                total[d, k] = total[d, k] + got if (d, k) in total else got
        if total:
            yield rows(total)
    # a slice has one row from each task that counted
    return _texts(docs).mapInArrow(count, schema).repartition("d", "slice").mapInArrow(add, schema)


def _merged(w: Windows, s: Suffixes, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(columns: language and words by id, -1 past the end; index of the first of equal suffixes; how many there are)."""
    cols = np.full((depth + 1, len(w.at)), -1, np.int32)
    cols[0] = s.lang[w.at]
    for d in range(depth):
        on = w.size > d
        cols[d + 1, on] = s.ids[w.at[on] + d]
    _, first, back, n = np.unique(w.lead[depth] + w.size.astype(U64), return_index=True, return_inverse=True, return_counts=True)
    odd = np.flatnonzero((cols != cols[:, first[back]]).any(0))  # unequal suffixes of one hash stay on their own
    n -= np.bincount(back[odd], minlength=len(n))
    return cols, np.concatenate((first, odd)), np.concatenate((n, np.ones(len(odd), np.int64)))


def routed(docs: DataFrame, plan, depth: int, routes: int) -> DataFrame:
    """route, langs, words, size, ids, since, n: suffixes of a run of documents that go to one task.

    ``ids`` has language and words of each of ``size`` suffixes (a column each, numbers in ``langs`` and ``words``, past the end the
    highest number); a suffix counts for phrases of ``since`` words or more, ``n`` times. Words and columns are compressed.
    """
    def each(s: Suffixes):
        marks, heavy, pair_bits = plan.value
        w = Windows(s, depth, lambda h: marks[_top(h, pair_bits)])
        if not len(w.at):
            return
        cols, first, n = _merged(w, s, depth)
        size = w.size[first]
        leads = {d: w.lead[d][first] for d in range(2, depth + 1)}
        since = np.zeros(len(first), np.int8)  # 0: every lead so far is heavy
        parts = []
        for d in range(2, depth + 1):
            open_ = (since == 0) & (size >= d)
            light = open_ & (np.full(len(first), d == depth) | ~heavy[d][_top(leads[d], LEAD_BITS)])
            since[light] = d
            shorter = np.flatnonzero(open_ & ~light)  # the phrase of d words is counted by itself
            if len(shorter):
                _, one, back = np.unique(leads[d][shorter], return_index=True, return_inverse=True)
                same = (cols[:d + 1, first[shorter]] == cols[:d + 1, first[shorter[one[back]]]]).all(0)
                sums = np.bincount(back, n[shorter] * same, len(one)).astype(np.int64)
                at = np.concatenate((shorter[one], shorter[~same]))
                part = cols[:, first[at]].copy()
                part[d + 1:] = -1
                parts.append((part, np.full(len(at), d, np.int8), np.concatenate((sums, n[shorter[~same]])), leads[d][at]))
        go = np.flatnonzero(since > 0)
        lead = np.zeros(len(go), U64)
        for d in leads:
            on = since[go] == d
            lead[on] = leads[d][go[on]]
        parts.append((cols[:, first[go]], since[go], n[go], lead))
        cols, since, n, lead = (np.concatenate([p[k] for p in parts], axis=-1) for k in range(4))
        route = (lead % U64(routes)).astype(np.int64)
        order = np.argsort(route, kind="stable")
        cuts = np.flatnonzero(np.diff(route[order], prepend=-1, append=routes))
        kinds = {"route": pa.int32(), "langs": pa.list_(pa.string()), "words": pa.binary(), "bytes": pa.int64(), "size": pa.int32(), "ids": pa.binary(), "since": pa.binary(), "n": pa.binary()}
        out = {k: [] for k in kinds}
        for i, j in zip(cuts[:-1], cuts[1:]):
            at = order[i:j]
            mine = cols[:, at]
            tags, lang = np.unique(mine[0], return_inverse=True)
            used, code = np.unique(mine[1:], return_inverse=True)
            code = code.reshape(depth, -1)
            if used[0] < 0:
                used, code = used[1:], np.where(code == 0, END, code - 1)
            words = b" ".join(s.words[k] for k in used.tolist())  # a word holds no space
            ids = np.vstack((lang, code)).astype("<u4")
            row = (int(route[order[i]]), [s.langs[k] for k in tags], pa.compress(words, codec="zstd", asbytes=True), len(words), j - i,
                   _pack(ids.view(np.uint8).reshape(-1, 4).T.copy()), _pack(since[at]), _pack(n[at].astype("<u4")))  # byte by byte, as high ones are alike
            for k, v in zip(out, row):
                out[k].append(v)
        yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds[k]) for k, v in out.items()})

    def run(batches):
        for b in batches:
            for s in _runs(b):
                yield from each(s)
    return _texts(docs).mapInArrow(run, "route int, langs array<string>, words binary, bytes long, size int, ids binary, since binary, n binary")


def gathered(batches, depth: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of a task: (names of languages and words, columns of ids into them, since, n)."""
    names, cols, since, n, before = [], [], [], [], 0
    for b in batches:
        for langs, words, length, size, ids, s, k in zip(*(b.column(i).to_pylist() for i in range(1, 8))):
            got = _unpack(ids, 4 * size * (depth + 1), np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(depth + 1, size)
            found = [x.encode() for x in langs] + pa.decompress(words, length, codec="zstd", asbytes=True).split(b" ")
            place = np.where(got == END, -1, got.astype(np.int64) + before)
            place[1:] += np.where(got[1:] == END, 0, len(langs))
            names.append(pa.array(found, pa.binary()))
            cols.append(place.astype(np.int32))
            since.append(_unpack(s, size, np.int8))
            n.append(_unpack(k, size, "<u4").astype(np.int64))
            before += len(found)
    if not cols:
        return pa.array([], pa.binary()), np.zeros((depth + 1, 0), np.int32), np.zeros(0, np.int8), np.zeros(0, np.int64)
    coded = pa.concat_arrays(names).dictionary_encode()
    codes = np.append(coded.indices.to_numpy(), -1).astype(np.int32)  # the last stands for the end
    return coded.dictionary, codes[np.concatenate(cols, axis=1)], np.concatenate(since), np.concatenate(n)


def multikey_sort(cols: np.ndarray, since: np.ndarray, n: np.ndarray, least: int, rng: np.random.Generator):
    """(pointer to a suffix, words, count) of every phrase with at least ``least`` occurrences.

    ``cols[0]`` is the language, ``cols[d]`` word d or -1. Partitions lie one after the other in ``ptr``.
    """
    depth = len(cols) - 1
    ptr = np.arange(cols.shape[1])
    size, at = np.array([len(ptr)]), np.zeros(1, np.int64)  # rows and the column of each partition
    found = []
    while len(ptr):
        seg = np.repeat(np.arange(len(size)), size)
        start = np.cumsum(size) - size
        value = cols[at[seg], ptr]
        pivot = value[start + (rng.random(len(size)) * size).astype(np.int64)]
        side = np.sign(value - pivot[seg]).astype(np.int8) + 1
        bin_ = seg * 3 + side
        rows = np.bincount(bin_, minlength=3 * len(size))
        place = np.cumsum(rows) - rows
        moved = np.empty_like(ptr)
        for k in range(3):  # stable: a row goes behind the earlier ones of its side
            on = np.flatnonzero(side == k)
            mine = bin_[on]
            new = np.ones(len(on), bool)
            new[1:] = mine[1:] != mine[:-1]
            first = np.maximum.accumulate(np.where(new, np.arange(len(on)), 0))
            moved[place[mine] + np.arange(len(on)) - first] = ptr[on]
        ptr = moved
        column = np.repeat(at, 3)
        equal = np.zeros(3 * len(size), bool)
        equal[1::3] = True
        bin_ = np.repeat(np.arange(len(rows)), rows)
        weight = np.bincount(bin_, n[ptr], len(rows))
        hit = np.flatnonzero(equal & (weight >= least) & (column >= 2))
        if len(hit):
            own = np.bincount(bin_, n[ptr] * (since[ptr] <= column[bin_]), len(rows))
            hit = hit[own[hit] >= least]
            found.append((ptr[place[hit]], column[hit], own[hit].astype(np.int64)))
        column = column + equal
        live = (weight >= least) & (column <= depth)
        keep = live[bin_]
        keep[keep] = cols[column[bin_[keep]], ptr[keep]] >= 0  # a suffix that has ended drops out
        ptr, bin_ = ptr[keep], bin_[keep]
        rows = np.bincount(bin_, minlength=len(rows))
        weight = np.bincount(bin_, n[ptr], len(rows))
        live = (rows > 0) & (weight >= least)
        ptr = ptr[live[bin_]]
        size, at = rows[live], column[live]
    return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3


def phrase_counts(docs: DataFrame, counts: DataFrame, least: int = MIN_COUNT, depth: int = DEPTH, task_suffixes: int = TASK_SUFFIXES) -> DataFrame:
    """lang, phrase, words, a: every phrase of 2 to ``depth`` words with at least ``least`` occurrences."""
    words = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    pair_bits = min(PAIR_BITS, max(LEAD_BITS, (words // 16).bit_length()))
    marks, heavy, total = np.zeros(1 << pair_bits, bool), np.zeros((depth + 1, 1 << LEAD_BITS), bool), 0
    for r in bucket_counts(docs, depth, pair_bits).toLocalIterator():  # a slice at a time
        got = _unpack(r.data, SLICE, np.int64)
        if r.d == 2:
            marks[r.slice * SLICE:(r.slice + 1) * SLICE] = got >= least
            total += int(got[got >= least].sum())
            wide = 1 << pair_bits - LEAD_BITS  # pair buckets of one lead bucket
            heavy[2, r.slice * SLICE // wide:(r.slice + 1) * SLICE // wide] = np.add.reduceat(np.where(got >= least, got, 0), np.arange(0, SLICE, wide)) > task_suffixes // 8
        else:
            heavy[r.d] = got > task_suffixes // 8
    plan = docs.sparkSession.sparkContext.broadcast((marks, heavy, pair_bits))
    routes = max(1, -(-total // task_suffixes))

    def sort(batches):
        words, cols, since, n = gathered(batches, depth)
        if not cols.shape[1]:
            return
        ptr, size, a = multikey_sort(cols, since, n, least, np.random.default_rng(len(n)))
        if not len(ptr):
            return
        names = words.to_pylist()
        text = [b" ".join(names[i] for i in cols[1:k + 1, p]).decode("utf-8", "replace") for p, k in zip(ptr.tolist(), size.tolist())]
        yield pa.RecordBatch.from_pydict({"lang": pa.array([names[i].decode() for i in cols[0, ptr]], pa.string()), "phrase": pa.array(text, pa.string()),
                                          "words": pa.array(size, pa.int32()), "a": pa.array(a, pa.int64())})

    sent = routed(docs, plan, depth, routes)
    return staged(sent.repartitionById(routes, "route").mapInArrow(sort, "lang string, phrase string, words int, a long"), "collocation-phrases")


# ------------------------------------------------------------------ scores
def _part(first: Column, size: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, size), " ")


def cut_scores(phrases: DataFrame, counts: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """lang, phrase, words, a, n and l, r, score of each phrase's lowest-scoring cut."""
    singles = counts.filter(F.col("n") >= least).select("lang", F.col("word").cast("string").alias("part"), F.col("n").alias("f"))
    known = singles.unionByName(phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")))
    known = known.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
    cuts = (phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumn("salt", F.pmod(F.xxhash64("phrase", "cut"), F.lit(SALTS)).cast("int"))
            .select("*", _part(F.lit(1), F.col("cut")).alias("head"), _part(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("tail")))
    # every part of a frequent phrase is frequent, so each cut finds both counts
    side = lambda name, f: known.select("lang", "salt", F.col("part").alias(name), F.col("f").alias(f))
    both = cuts.join(side("head", "l"), ["lang", "salt", "head"]).join(side("tail", "r"), ["lang", "salt", "tail"])
    both = both.join(counts.groupBy("lang").agg(F.sum("n").alias("n")), "lang")
    digits = "decimal(18,0)"  # products of two have at most 37 digits
    score = F.expr(f"(cast(1000 * a as {digits}) * cast(n as {digits})) div (cast(l as {digits}) * cast(r as {digits}))")
    best = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best")
    return (both.groupBy("lang", "phrase", "words", "a", "n").agg(best)
            .select("lang", "phrase", "words", "a", "n", "best.l", "best.r", "best.score"))


def absorbed(phrases: DataFrame) -> DataFrame:
    """lang, phrase of candidates that a longer one holds as often as they occur.

    Counts never grow with length, so if any longer phrase is as frequent, one with a single word more is.
    """
    longer = phrases.filter("words > 2")
    part = F.explode(F.array(_part(F.lit(1), F.col("words") - 1), _part(F.lit(2), F.col("words") - 1)))
    most = longer.select("lang", part.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    return phrases.join(most, ["lang", "phrase"]).filter(F.col("most") >= F.col("a")).select("lang", "phrase")


def collocations(docs: DataFrame, least: int = MIN_COUNT, depth: int = DEPTH, top: int = TOP, task_suffixes: int = TASK_SUFFIXES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    counts = word_counts(docs)
    phrases = phrase_counts(docs, counts, least, depth, task_suffixes)
    scored = cut_scores(phrases, counts, least).join(absorbed(phrases), ["lang", "phrase"], "left_anti")
    first = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy(F.desc("score"), F.desc("a"), "phrase"))
    # a language's phrases are first limited in SALTS groups, so that its task ranks SALTS * top rows at most
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    salted = salted.withColumn("rank", first("salt")).filter(F.col("rank") <= top)
    return (salted.withColumn("rank", first()).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
