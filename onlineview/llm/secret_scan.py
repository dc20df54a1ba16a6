"""Secret scan: pattern spans, and credential-context values whose guess cost is high.

The guess cost of a value is found by dynamic programming over its cheapest
segmentation into ranked words, dates, repeats, keyboard walks and brute-force
characters (log10 guesses, each further segment costing a factor of two). A value
after a credential name that costs at least ``MIN_COST`` and touches no pattern span
is added as a ``guess`` span, whatever its length. Words are ranked by a list of common password words, then by
the number of documents that hold them (:func:`corpus_words`), so prose after a name is cheap. Placeholders, calls and addresses
are references, not secrets; what follows ``Bearer`` or ``Basic`` is a value. A value that opens with a quote ends
at the closing quote of its line; any other ends at white space, or at a separator before the next
credential name, less trailing punctuation and unmatched closing brackets. Code points
beyond ASCII count as one more alphabet.

Defined results: a null or empty text has no spans; positions are code points, ends
exclusive; repeated rows get equal results; other columns are never read; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import FOLD, Words, blob, bytes_of, chunks, mapped

ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "guess")
MIN_VALUE = 12
MIN_ACCESS = 18

_NAMES = rb"""(?i:pass(?:word|wd|phrase|code)?|pwd|secret(?:[_-]?key)?|token|api[_-]?key|access[_-]?key|private[_-]?key|auth(?:orization)?|credentials?|login)["']?[\x20\t]*(?:=>|:=|[:=])"""
#: Names that make what follows a credential value: quoted, or up to white space or a separator before the next name.
CONTEXT = re.compile(_NAMES + rb"""[\x20\t]*(?:(?i:bearer|basic)[\x20\t]+)?(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`|["'`]?((?:(?![,;&|?]["']?""" + _NAMES + rb""")[^\x00-\x20\x7f])+))""")
#: Values that only name where a secret comes from: placeholders, variables, calls and lookups, and addresses without a password.
REFERENCE = re.compile(r"""\$\{[^{}]*\}|\$\([^()]*\)|\{\{.*\}\}|<[^<>]*>|%\w+%|\$[A-Za-z_]\w*|[A-Za-z_][\w.]*(?:\(.*\)|\[.*\])|[A-Za-z][A-Za-z0-9+.-]*://[^\s@]*""", re.A | re.S)
#: Words of the corpus that extend the list of password words, by the number of documents they stand in.
CORPUS_WORDS = 5000
#: Documents that a word has to stand in, so that pieces of a secret are no words.
CORPUS_LEAST = 3
_WORD_LETTERS = (3, 24)
_WHITE = re.compile(r"\s")
_OPENERS = {")": "(", "]": "[", "}": "{", ">": "<"}
_HINTS = (b"pass", b"pwd", b"secret", b"token", b"key", b"auth", b"credential", b"login")
#: log10 of the guesses from which a value counts as a secret.
MIN_COST = 9.0
#: Characters of the alphabet that code points beyond ASCII add (those of Latin-1).
BEYOND_ASCII = 96

# Keyboard rows, and common password words in order of rank.
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
WORDS = ("password", "admin", "welcome", "login", "qwerty", "letmein", "master", "dragon", "monkey", "hello", "secret", "test", "guest", "root",
         "user", "default", "changeme", "love", "sunshine", "princess", "football", "baseball", "summer", "winter", "spring", "autumn", "abc",
         "pass", "shadow", "super", "example", "sample", "dummy", "token", "value", "server", "data", "public", "private", "system", "access",
         "the", "and", "for", "you", "your", "with", "this", "that", "from", "here", "none", "null", "true", "false", "string", "change", "me")


def _keyboard() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    for r, row in enumerate(_ROWS):
        for c, key in enumerate(row):
            for dr, dc in ((0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)):
                if 0 <= r + dr < len(_ROWS) and 0 <= c + dc < len(_ROWS[r + dr]):
                    near.setdefault(key, set()).add(_ROWS[r + dr][c + dc])
    return near


_NEAR = _keyboard()
_KEYS = len(_NEAR)
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d", re.A)
_YEAR = re.compile(r"(?:19|20)\d\d", re.A)
_STEP = math.log10(2)


def char_cost(text: str) -> float:
    """log10 of the alphabet that brute force has to try for each character of ``text``."""
    plain = [c for c in text if c.isascii()]
    size = sum(n for n, test in ((26, str.islower), (26, str.isupper), (10, str.isdigit)) if any(map(test, plain)))
    return math.log10(size + 33 * any(not c.isalnum() for c in plain) + BEYOND_ASCII * (len(plain) < len(text)) or 1)


def guess_cost(text: str, words: dict[str, int]) -> tuple[float, list[tuple[str, int, int]]]:
    """log10 guesses of the cheapest segmentation, and that segmentation as (kind, start, end).

    ``words`` maps lower-case words to their rank from 1. Walks and brute force grow by a fixed cost a
    character, so one state each carries their best start; a repeat's start is dropped once an earlier
    one is cheaper, as it then is for every longer repeat. Time is about linear in the text.
    """
    n, low = len(text), "".join(x if len(x := c.lower()) == 1 else c for c in text)  # one character for each
    longest, per, inf = max(map(len, words), default=0), char_cost(text), math.inf
    best, back = [0.0] + [inf] * n, [(0, "")] * (n + 1)
    dates: dict[int, list[tuple[int, float]]] = {}
    walk_cost, walk_start, walk_run = inf, 0, 0  # best segmentation that ends here in a walk of 3 or more
    force_cost, force_start = inf, 0  # the same in brute force
    runs, starts = [0] * 5, [[] for _ in range(5)]  # by block size: matches so far, starts of repeats worth keeping

    for j in range(1, n + 1):
        i = j - 1
        for pattern, days in ((_DATE, 365 * 200), (_YEAR, 200)):
            if m := pattern.match(text, i):
                dates.setdefault(m.end(), []).append((i, math.log10(days)))
        force_cost += per
        if best[i] + (_STEP if i else 0) + per < force_cost:
            force_cost, force_start = best[i] + (_STEP if i else 0) + per, i
        found = [(force_start, per * (j - force_start), "brute")]
        for size in range(1, min(longest, j) + 1):
            if rank := words.get(low[j - size:j]):
                found.append((j - size, math.log10(rank + 1) + (_STEP if text[j - size:j] != low[j - size:j] else 0), "word"))
        found += [(a, cost, "date") for a, cost in dates.pop(j, ())]

        walk_run = walk_run + 1 if i and low[i] in _NEAR.get(low[i - 1], ()) else 0
        walk_cost = walk_cost + _STEP if walk_run >= 2 else inf
        if walk_run >= 2:
            a = j - 3
            fresh = best[a] + (_STEP if a else 0) + math.log10(_KEYS) + 2 * _STEP
            if fresh < walk_cost:
                walk_cost, walk_start = fresh, a
            found.append((walk_start, walk_cost - best[walk_start] - (_STEP if walk_start else 0), "walk"))

        for size in range(1, 5):
            runs[size] = runs[size] + 1 if i >= size and low[i] == low[i - size] else 0
            need = max(2, size)
            if runs[size] < need:
                starts[size] = []
                continue
            kept, least = [], inf
            for a in [*starts[size], j - size - need]:  # earlier starts first
                cost = size * per + math.log10((j - a) / size)
                total = best[a] + (_STEP if a else 0) + cost
                if total < least:
                    kept.append(a)
                    least = total
                    found.append((a, cost, "repeat"))
            starts[size] = kept

        for a, cost, kind in found:
            total = best[a] + cost + (_STEP if a else 0)
            if total < best[j]:
                best[j], back[j] = total, (a, kind)

    parts, j = [], n
    while j:
        i, kind = back[j]
        parts.append((kind, i, j))
        j = i
    return best[n], parts[::-1]


def pattern_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the fixed patterns, leftmost and non-overlapping for each kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def trimmed(value: str) -> str:
    """An unquoted value up to white space, without punctuation, quotes and unmatched closing brackets at its end."""
    value = _WHITE.split(value, maxsplit=1)[0]
    while value and (value[-1] in ".,:;\"'`" or value[-1] in _OPENERS and value.count(value[-1]) > value.count(_OPENERS[value[-1]])):
        value = value[:-1]
    return value


def guess_spans(text: bytes, base: list[tuple[int, int, int]], words: dict[str, int], min_cost: float = MIN_COST) -> list[tuple[int, int, int]]:
    """Credential values of high guess cost that touch no span of ``base``."""
    out, pos = [], 0
    while m := CONTEXT.search(text, pos):
        st, pos = m.start(m.lastindex), m.end()
        value = m[m.lastindex].decode("utf-8", "surrogateescape")
        if m.lastindex == 4:
            value = trimmed(value)
        en = st + len(value.encode("utf-8", "surrogateescape"))
        if any(a < en and st < b for a, _, b in base):
            if m.lastindex < 4:  # names inside the quotes have values of their own
                pos = st
        elif value and not REFERENCE.fullmatch(value) and guess_cost(value, words)[0] >= min_cost:
            out.append((st, 3, en))
    return out


def _code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or text.isascii():
        return spans
    at = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [(int(at[a]), k, int(at[b])) for a, k, b in spans]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def ranked(words=WORDS) -> dict[str, int]:
    return {w.lower(): i for i, w in reversed(list(enumerate(words, 1)))}


def corpus_words(docs: DataFrame, top: int = CORPUS_WORDS, least: int = CORPUS_LEAST) -> list[str]:
    """The ``top`` words in most documents, ``least`` or more (ASCII letters, lower-cased; ties by the word), from most to fewest."""
    letters = np.ones(256, bool)
    letters[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = False  # all else separates

    def each(b):
        data, offs = blob(b.column(0))
        out = []
        for i, j in chunks(offs):
            d = FOLD[data[offs[i]:offs[j]]]
            w = Words(d, offs[i:j + 1] - offs[i], letters)
            size = w.en - w.st
            at = np.concatenate(([0], np.cumsum(size)))
            coded = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(d[~letters[d]])]).dictionary_encode()
            ids = coded.indices.to_numpy()
            fit = (size >= _WORD_LETTERS[0]) & (size <= _WORD_LETTERS[1])
            once = np.unique(w.doc[fit] * len(coded.dictionary) + ids[fit])  # a document counts once
            n = np.bincount(once % max(len(coded.dictionary), 1), minlength=len(coded.dictionary))
            out.append((coded.dictionary.cast(pa.binary()).filter(pa.array(n > 0)), n[n > 0]))
        words = pa.concat_arrays([w for w, _ in out]).cast(pa.string())
        return {"word": words, "n": pa.array(np.concatenate([n for _, n in out]), pa.int64())}

    texts = docs.select(bytes_of("text")).filter("text IS NOT NULL")
    counted = mapped(texts, each, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # each of 16 groups is limited where it is sorted, so that the driver gets 16 * top words at most, whatever the number of tasks
    first = F.row_number().over(Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(16))).orderBy(F.desc("n"), "word"))
    best = counted.filter(F.col("n") >= least).withColumn("nth", first).filter(F.col("nth") <= top)
    return [r.word for r in sorted(best.collect(), key=lambda r: (-r.n, r.word))[:top]]


def scan(docs: DataFrame, words=WORDS, min_cost: float = MIN_COST) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans for every row."""
    table = ranked(words)

    def one(text: bytes):
        low = text.lower()
        hinted = any(h in low for h in _HINTS)  # every pattern with a name contains one of these
        base = pattern_spans(text) if hinted else sorted(
            [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS] + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])
        more = guess_spans(text, base, table, min_cost) if hinted else []
        everything = _code_points(text, sorted(base + more))
        return base, len(more), _joined([s for s in everything if s[1] < 3]), _joined(everything)

    def each(b):
        rows = [one(t or b"") for t in b.column(1).to_pylist()]
        count = lambda k: pa.array([sum(s[1] == k for s in r[0]) for r in rows], pa.int64())
        return {"doc_id": b.column(0), "n_assign": count(0), "n_access": count(1), "n_hex": count(2), "n_guess": pa.array([r[1] for r in rows], pa.int64()),
                "base_sha256": pa.array([hashlib.sha256(r[2].encode()).hexdigest() for r in rows]), "spans": pa.array([r[3] for r in rows])}

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of("text")), each,
                  "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")
