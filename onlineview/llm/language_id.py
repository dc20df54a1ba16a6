"""Language identification: script ranges narrow the languages, then Viterbi labels spans of mixed-language text.

A word is a run of letters (and marks) of one script. Its script leaves as candidates the languages that
write a fair share of their letters in it. Each candidate scores the word by naive Bayes over
its hashed character n-grams with borders (lengths 1 to 4) and the word as a whole, tempered, since n-grams of a word overlap.
The best sequence of languages under a penalty for each switch gives the spans; the text's language is
the one with the most letters in them, and its share of letters is the score.

Viterbi runs over all documents of a batch at once, a word a step. A longer text is cut into segments of SEGMENT words
that are solved side by side from every language they may start in and then linked, which is exact, so the
steps are bounded for texts of any length.

The model is learnt from about PER_LANGUAGE documents of each language (chosen by a hash of the id at a rate that its
count sets) outside the held-out fold: n-gram counts added up by Spark. Source, id and labels are no inputs.

Defined results: a null text, or one without a letter, is `und` with score 0; ties go to the language
that sorts first; repeated rows get equal results; other columns are never read; without any labelled
text every document is `und`; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import learn
from .text import U64, blob, bytes_of, chunks, mapped, mix

UNKNOWN = "und"
#: Documents of each language that are learnt from, on average.
PER_LANGUAGE = 1500
#: Buckets for n-grams, as bits.
GRAM_BITS = 16
LONGEST = 4
#: Nats that a change of language costs.
SWITCH = 6.0
#: Least share of a language's letters in a script that makes it a candidate there.
SCRIPT_SHARE = 0.01
#: Words of a segment.
SEGMENT = 512
#: Pseudo-count of an n-gram bucket.
SMOOTH = 0.5
#: Log probabilities of overlapping n-grams count by this factor.
TEMPER = 0.25
#: Score of a language that does not write in a word's script.
OUT = -30.0

# First code points of the blocks in which scripts are written (fixed values, from the Unicode block names).
SCRIPTS = [
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x0800, "Hebrew"), (0x0860, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"),
    (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1200, "Ethiopic"), (0x13A0, "Cherokee"), (0x1400, "Canadian"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x1C80, "Cyrillic"), (0x1C90, "Georgian"),
    (0x1D00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"), (0x2DE0, "Cyrillic"), (0x2E00, "Han"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"),
    (0x3190, "Han"), (0x31F0, "Kana"), (0x3200, "Han"), (0xA000, "Yi"), (0xA4D0, "Latin"), (0xA640, "Cyrillic"), (0xA6A0, "Latin"), (0xAC00, "Hangul"), (0xD800, "Latin"),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Latin"), (0xFE70, "Arabic"), (0xFF00, "Latin"),
    (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "Other"), (0x1B000, "Kana"), (0x1D400, "Latin"), (0x1E000, "Other"), (0x20000, "Han"), (0x40000, "Other"),
]
NAMES = sorted({name for _, name in SCRIPTS})
_POINTS = 0x110000
_TABLES: dict[str, np.ndarray] = {}


def tables() -> tuple[np.ndarray, np.ndarray]:
    """(script number of each code point of a letter or mark, 0 elsewhere; whether it is a letter), made once in a worker."""
    if not _TABLES:
        kind = [unicodedata.category(chr(c))[0] for c in range(_POINTS)]
        letter = np.fromiter((k == "L" for k in kind), bool, _POINTS)
        script = np.zeros(_POINTS, np.uint8)
        for (a, name), (b, _) in zip(SCRIPTS, [*SCRIPTS[1:], (_POINTS, "")]):
            script[a:b] = NAMES.index(name) + 1
        script[~(letter | np.fromiter((k == "M" for k in kind), bool, _POINTS))] = 0
        lower = np.arange(_POINTS, dtype=np.uint32)
        for c in np.flatnonzero(letter).tolist():
            low = chr(c).lower()
            if len(low) == 1:
                lower[c] = ord(low)
        _TABLES.update(script=script, letter=letter, lower=lower)
    return _TABLES["script"], _TABLES["letter"]


class Points:
    """Code points of a run of texts with their words: ``doc``, ``st``, ``en`` (places in the run), ``script``, ``letters``."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
        self.at = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
        self.cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        scripts, letters = tables()
        kind = scripts[self.cp]
        on = kind > 0
        edge = np.ones(len(kind) + 1, bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[self.at] = True
        self.st = np.flatnonzero(on & edge[:-1])
        self.en = np.flatnonzero(on & edge[1:]) + 1
        self.script = kind[self.st].astype(np.int64)
        total = np.concatenate(([0], np.cumsum(letters[self.cp], dtype=np.int32)))
        self.letters = (total[self.en] - total[self.st]).astype(np.int64)
        self.doc = np.searchsorted(self.at, self.st, "right") - 1
        self.n = len(texts)

    def grams(self, i: int, j: int):
        """(index of the word from i, bucket) of every n-gram of the bordered words i to j, one length at a time, then of whole words."""
        st = self.st[i:j]
        size = self.en[i:j] - st + 2  # with a border on each side
        at = np.concatenate(([0], np.cumsum(size)))
        word = np.repeat(np.arange(len(size)), size)
        place = np.arange(at[-1]) - at[word]
        inner = (place > 0) & (place < size[word] - 1)
        c = np.full(at[-1], 0x20, U64)
        c[inner] = _TABLES["lower"][self.cp[(st[word] + place - 1)[inner]]]
        acc = mix(c + U64(0x9E3779B97F4A7C15))
        order = mix(acc + U64(0x632BE59BD9B4E019) * place.astype(U64))  # a letter with its place
        whole = np.add.reduceat(order, at[:-1])
        shift = U64(64 - GRAM_BITS)
        yield word[inner], (acc[inner] >> shift).astype(np.int64)
        for k in range(2, LONGEST + 1):
            acc = mix(acc[:-1] * U64(0x9E3779B97F4A7C15) + c[k - 1:])
            ok = word[:len(acc)] == word[k - 1:]
            yield word[:len(acc)][ok], (acc[ok] >> shift).astype(np.int64)
        yield np.arange(len(size)), (mix(whole) >> shift).astype(np.int64)

    def slices(self, words: int = 1 << 17):
        """Runs of words whose n-grams are looked at together, so that a very long text needs no more memory."""
        return [(i, min(i + words, len(self.st))) for i in range(0, len(self.st), words)]


# ------------------------------------------------------------------ spans
def _forward(e: np.ndarray, first: np.ndarray, sizes: np.ndarray, v: np.ndarray, switch: float, trace: bool):
    """Viterbi of S segments of ``e`` side by side; ``v`` (S x K x L) scores each language before the first word, from K starts.

    Returns the scores after the last word and, on demand, T x S x K x L: the language of the word before.
    """
    steps, langs = int(sizes.max()), e.shape[1]
    own = np.arange(langs, dtype=np.int16)
    back = np.empty((steps, *v.shape), np.int16) if trace else None
    for t in range(steps):
        best = v.argmax(2)[..., None]
        jump = np.take_along_axis(v, best, 2) - np.float32(switch)
        on = (t < sizes)[:, None, None]  # past its end a segment stays as it is
        stay = (v >= jump) | ~on
        if trace:
            back[t] = np.where(stay, own, best)
        word = e[np.minimum(first + t, len(e) - 1)][:, None, :]
        v = np.where(stay, v, jump) + np.where(on, word, np.float32(0))
    return v, back


def viterbi(e: np.ndarray, counts: np.ndarray, switch: float = SWITCH, segment: int = SEGMENT, block: int = 1 << 24) -> np.ndarray:
    """Best language of every word. ``counts`` are the words of each document; their scores lie one after the other in ``e``."""
    langs = e.shape[1]
    out = np.zeros(len(e), np.int16)
    docs = np.flatnonzero(counts > 0)
    if not len(docs) or langs < 2:
        return out
    parts = -(-counts[docs] // segment)
    doc = np.repeat(docs, parts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = (np.cumsum(counts) - counts)[doc] + nth * segment
    sizes = np.minimum(counts[doc] - nth * segment, segment)
    start = np.zeros((len(doc), langs), np.float32)  # a document starts in any language
    last = np.full(len(doc), -1)

    many = np.flatnonzero(np.repeat(parts, parts) > 1)
    if len(many):
        ends = np.empty((len(many), langs, langs), np.float32)
        step = max(1, block // (langs * langs * 64))
        for i in range(0, len(many), step):
            seg = many[i:i + step]
            unit = np.where(np.eye(langs, dtype=bool), np.float32(0), np.float32(-np.inf))  # the word before was in language k
            v = np.where((nth[seg] == 0)[:, None, None], np.float32(0), unit)
            ends[i:i + step] = _forward(e, first[seg], sizes[seg], v, switch, False)[0]
        came = np.empty((len(many), langs), np.int64)
        for i, s in enumerate(many):  # one small step for each segment
            if nth[s] == 0:
                total = ends[i, 0].astype(np.float64)
            else:
                way = total[:, None] + ends[i]
                came[i], total = way.argmax(0), way.max(0)
            if i + 1 == len(many) or nth[many[i + 1]] == 0:
                now = int(total.argmax())
                for k in range(i, i - int(nth[s]) - 1, -1):
                    last[many[k]] = now
                    if nth[many[k]]:
                        now = int(came[k, now])
                        start[many[k]] = -np.inf
                        start[many[k], now] = 0
    order = np.argsort(sizes, kind="stable")  # alike in size, so little is padded
    step = max(1, block // (langs * segment))
    for i in range(0, len(order), step):
        seg = order[i:i + step]
        v, back = _forward(e, first[seg], sizes[seg], start[seg][:, None, :], switch, True)
        now = np.where(last[seg] >= 0, last[seg], v[:, 0].argmax(1))
        row = np.arange(len(seg))
        for t in range(len(back) - 1, -1, -1):
            on = t < sizes[seg]
            out[first[seg][on] + t] = now[on]
            now = back[t, row, 0, now]
    return out


# ------------------------------------------------------------------ the model
@dataclass
class Languages:
    names: list[str]
    weight: np.ndarray  # language x bucket, log probabilities
    writes: np.ndarray  # script x language

    def words(self, p: Points) -> np.ndarray:
        """Score of every word in every language, the best being 0."""
        out = np.zeros((len(p.st), len(self.names)), np.float32)
        for i, j in p.slices():
            total = np.zeros((len(self.names), j - i))
            for word, bucket in p.grams(i, j):
                for k, w in enumerate(self.weight):
                    total[k] += np.bincount(word, w[bucket], j - i)
            total = total.T * TEMPER
            allowed = self.writes[p.script[i:j]]
            allowed = allowed | ~allowed.any(1, keepdims=True)  # a script that no language writes narrows nothing
            total = np.where(allowed, total, -np.inf)
            out[i:j] = np.maximum(total - total.max(1, keepdims=True), OUT)
        return out

    def identify(self, data: np.ndarray, offs: np.ndarray):
        """For a run of texts: (language number or -1, share of the letters, words, language of each word)."""
        p = Points(data, offs)
        if not self.names:
            return np.full(p.n, -1), np.zeros(p.n), p, np.zeros(len(p.st), np.int16)
        path = viterbi(self.words(p), np.bincount(p.doc, minlength=p.n))
        langs = len(self.names)
        letters = np.bincount(p.doc * langs + path, p.letters, p.n * langs).reshape(p.n, langs)
        total, best = letters.sum(1), letters.argmax(1)
        share = np.divide(letters[np.arange(p.n), best], total, out=np.zeros(p.n), where=total > 0)
        return np.where(total > 0, best, -1), share, p, path


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Languages:
    """Learn from about ``per_language`` documents of each language outside the held-out fold."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (learn.fold() != learn.HELD_OUT))
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), bytes_of("text"))
    rows = sorted((r.lang, r["count"]) for r in usable.groupBy("lang").count().collect())
    names = [r[0] for r in rows]
    if not names:
        return Languages([], np.zeros((0, 1 << GRAM_BITS), np.float32), np.zeros((len(NAMES) + 1, 0), bool))
    rates = docs.sparkSession.createDataFrame([(n, k, per_language / c) for k, (n, c) in enumerate(rows)], "lang string, k int, rate double")
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    sample = usable.join(F.broadcast(rates), "lang").filter(unit < F.col("rate")).select("k", "text")  # one row for each language

    def each(b):
        k = b.column(0).to_numpy()
        data, offs = blob(b.column(1))
        langs = len(names)
        count = np.zeros((langs, (1 << GRAM_BITS) + len(NAMES) + 1), np.int64)
        for i, j in chunks(offs):
            p = Points(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            lang = k[i:j][p.doc]
            np.add.at(count, (lang, (1 << GRAM_BITS) + p.script), p.letters)
            for x, y in p.slices():
                for word, bucket in p.grams(x, y):
                    count += np.bincount(lang[x:y][word] * count.shape[1] + bucket, minlength=count.size).reshape(count.shape)
        lang, slot = np.nonzero(count)
        return {"k": pa.array(lang, pa.int32()), "slot": pa.array(slot, pa.int32()), "n": pa.array(count[lang, slot])}

    # at most a row for each language and bucket, whatever the input
    got = mapped(sample, each, "k int, slot int, n long").groupBy("k", "slot").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros((len(names), (1 << GRAM_BITS) + len(NAMES) + 1))
    count[got["k"].to_numpy(), got["slot"].to_numpy()] = got["n"].to_numpy()
    grams, letters = count[:, :1 << GRAM_BITS] + SMOOTH, count[:, 1 << GRAM_BITS:]
    writes = letters >= SCRIPT_SHARE * np.maximum(letters.sum(1, keepdims=True), 1)
    return Languages(names, np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32), writes.T.copy())


def identify(docs: DataFrame, model: Languages, spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, n_spans for every row, and on demand the spans: start, end (code points, exclusive), lang."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 256 KB a language

    def each(b):
        data, offs = blob(b.column(1))
        m = shared.value
        best, share, number, runs = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)], []
        for i, j in chunks(offs):
            k, s, p, path = m.identify(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            new = np.ones(len(path), bool)
            new[1:] = (path[1:] != path[:-1]) | (p.doc[1:] != p.doc[:-1])
            at = np.flatnonzero(new)
            best.append(k), share.append(s), number.append(np.bincount(p.doc[at], minlength=p.n) * (k >= 0))
            if spans:
                found = [[] for _ in range(p.n)]
                base = p.at[p.doc]
                stop = np.append(at[1:], len(path)) - 1
                if m.names:
                    for d, x, y, lang in zip(p.doc[at].tolist(), (p.st - base)[at].tolist(), (p.en - base)[stop].tolist(), path[at].tolist()):
                        found[d].append({"start": x, "end": y, "lang": m.names[lang]})
                runs += found
        names = pa.array([*m.names, UNKNOWN], pa.string())
        out = {"doc_id": b.column(0), "lang_pred": names.take(pa.array(np.concatenate(best) % len(names))), "score": pa.array(np.concatenate(share)),
               "n_spans": pa.array(np.concatenate(number), pa.int64())}
        return out | ({"spans": pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])))} if spans else {})

    schema = "doc_id long, lang_pred string, score double, n_spans long" + (", spans array<struct<start: long, end: long, lang: string>>" if spans else "")
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of("text")), each, schema)
