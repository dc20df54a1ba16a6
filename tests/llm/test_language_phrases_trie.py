"""Language identification, phrase collocations and the conversation trie against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures_llm import documents, empty, rows
from onlineview.llm import collocations, conversation_trie, language_id, learn

SF = "/root/testdata/sf0.1"


# ------------------------------------------------------------------ language identification
def plain_viterbi(e, switch):
    v, back = np.zeros(e.shape[1]), []
    for row in e:
        jump = v.max() - switch
        back.append(np.where(v >= jump, np.arange(len(v)), v.argmax()))
        v = np.maximum(v, jump) + row
    path = [int(v.argmax())]
    for b in back[:0:-1]:
        path.append(int(b[path[-1]]))
    return path[::-1]


def path_score(e, path, switch):
    return sum(e[i, k] for i, k in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))


@pytest.mark.parametrize("segment", [1, 3, 7, 64])
def test_segments_give_the_best_path(segment):
    rng = np.random.default_rng(segment)
    counts = np.array([0, 1, 2, 50, 0, 7, 64, 13])
    e = rng.normal(0, 2, (counts.sum(), 4)).astype(np.float32)
    got = language_id.viterbi(e, counts, 3.0, segment=segment, block=200)
    at = np.concatenate(([0], np.cumsum(counts)))
    for i, j in zip(at[:-1], at[1:]):
        if j > i:
            assert path_score(e[i:j], got[i:j], 3.0) == pytest.approx(path_score(e[i:j], plain_viterbi(e[i:j], 3.0), 3.0), abs=1e-3)


def test_scripts_narrow_the_candidates():
    data = np.frombuffer("Haus дом οἶκος 家 naïve".encode(), np.uint8)
    p = language_id.Points(data, np.array([0, len(data)]))
    assert [language_id.NAMES[s - 1] for s in p.script] == ["Latin", "Cyrillic", "Greek", "Han", "Latin"]
    m = language_id.Languages(["de", "ru"], np.zeros((2, 1 << language_id.GRAM_BITS), np.float32), np.zeros((len(language_id.NAMES) + 1, 2), bool))
    m.writes[language_id.NAMES.index("Latin") + 1, 0] = m.writes[language_id.NAMES.index("Cyrillic") + 1, 1] = True
    assert m.words(p).tolist() == [[0, language_id.OUT], [language_id.OUT, 0], [0, 0], [0, 0], [0, language_id.OUT]]


@pytest.fixture(scope="module")
def languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, language_id.fit(docs)


def test_held_out_accuracy(languages):
    docs, model = languages
    held = docs.filter(learn.fold() == learn.HELD_OUT)
    got = language_id.identify(held, model).join(held.select("doc_id", "lang"), "doc_id")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("long")), F.count("*")).first()
    assert right >= 0.995 * n


def test_spans_of_mixed_texts(spark, languages):
    docs, model = languages
    held = docs.filter((learn.fold() == learn.HELD_OUT) & (F.length("text") > 2000))
    texts = {lang: [r.text for r in held.filter(F.col("lang") == lang).orderBy("doc_id").limit(8).collect()] for lang in model.names}
    rng, made = random.Random(3), []
    for k in range(40):
        a, b = rng.sample(model.names, 2)
        x, y = rng.choice(texts[a])[:rng.choice([80, 300])], rng.choice(texts[b])[:rng.choice([80, 300])]
        made.append((k, f"{x} {y}", a, b, len(x)))
    got = {r.doc_id: r.spans for r in language_id.identify(spark.createDataFrame(made, "doc_id long, text string, a string, b string, cut int"), model, spans=True).collect()}
    right = total = 0
    for k, text, a, b, cut in made:
        lang = [None] * len(text)
        for s in got[k]:
            lang[s.start:s.end] = [s.lang] * (s.end - s.start)
        for i, c in enumerate(text):
            if c.isalpha():
                total, right = total + 1, right + (lang[i] == (a if i < cut else b))
    assert right >= 0.98 * total


def test_language_of_awkward_texts(spark):
    df = documents(spark)
    model = language_id.fit(df)
    got = Counter((r.doc_id, r.lang_pred) for r in language_id.identify(df, model).collect())
    assert got == Counter((r[0], "en" if any(c.isalpha() for c in r[1] or "") else "und") for r in rows())
    assert language_id.identify(empty(spark), model).count() == 0
    blank = language_id.fit(empty(spark))
    assert {r.lang_pred for r in language_id.identify(df, blank, spans=True).collect()} == {"und"}


def test_held_out_rows_are_not_learnt(spark):
    df = spark.createDataFrame([(i, "abc def", "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else "yy") for i in range(40)] + [(None, "abc", "zz")], "doc_id long, text string, lang string")
    assert language_id.fit(df).names == ["yy"]


# ------------------------------------------------------------------ collocations
def plain_phrases(docs, least, depth=5):
    words, n = defaultdict(int), defaultdict(int)
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, depth + 1):
                    if i + k <= len(w):
                        words[lang, tuple(w[i:i + k])] += 1
    f = {k: v for k, v in words.items() if v >= least}
    held = set()
    for (lang, p), a in f.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if 100 * a >= 100 * f[lang, p[i:i + k]]:
                    held.add((lang, p[i:i + k]))
    out = defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) > 1 and (lang, p) not in held:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return [(lang, r, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items() for r, (s, a, p, x, y) in enumerate(sorted(found)[:2000], 1)]


COLUMNS = "lang rank phrase a l r n score".split()


@pytest.mark.parametrize("task_suffixes", [1 << 20, 64])  # the small one makes nearly all leads heavy
def test_collocations_equal_plain_counts(spark, task_suffixes):
    rng = random.Random(11)
    vocabulary = ["Of", "the", "ñandú", "x", "y", "z", "日本", "a-b", "\x0b".strip() or "q", "of"]
    texts = [(rng.choice(["en", "fr", None, ""]), rng.choice([" ", "  ", "\t"]).join(
        w + rng.choice(["", "", "", ",", ".", "!\n"]) for w in rng.choices(vocabulary, [9, 8, 3, 2, 2, 1, 1, 1, 1, 5], k=rng.randint(0, 60)))) for _ in range(300)]
    texts += [("en", "the hot pair then " + str(i)) for i in range(200)] + [("en", None), (None, None), ("en", ""), ("de", "one two three four five six " * 40)]
    df = spark.createDataFrame([(lang, t, "clash", 1, "k") for lang, t in texts], "lang string, text string, phrase string, n int, word string").repartition(5)
    got = [tuple(r) for r in collocations.collocations(df, least=10, task_suffixes=task_suffixes).select(*COLUMNS).collect()]
    assert sorted(got) == sorted(plain_phrases(texts, 10))
    assert any(r[2].count(" ") == 4 for r in got)


def test_multikey_sort_counts_weighted_suffixes():
    rng = np.random.default_rng(2)
    cols = np.vstack((rng.integers(0, 2, 3000), rng.integers(0, 6, (5, 3000)))).astype(np.int32)
    ends = rng.integers(2, 6, 3000)
    for d in range(1, 6):
        cols[d, ends < d] = -1
    n = rng.integers(1, 4, 3000)
    ptr, size, a = collocations.multikey_sort(cols, np.full(3000, 2, np.int8), n, 12, rng)
    want = Counter()
    for i in range(3000):
        for k in range(2, int(ends[i]) + 1):
            want[tuple(cols[:k + 1, i])] += int(n[i])
    assert {tuple(cols[:k + 1, p]): int(c) for p, k, c in zip(ptr, size, a)} == {k: v for k, v in want.items() if v >= 12}


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10 ** 13
    phrases = spark.createDataFrame([("en", "p q", 2, big - 7)], "lang string, phrase string, words int, a long")
    counts = spark.createDataFrame([("en", b"p", big - 1), ("en", b"q", big + 3), ("en", b"r", 7 * big)], "lang string, word binary, n long")
    r = collocations.cut_scores(phrases, counts).first()
    assert r.score == 1000 * (big - 7) * (9 * big + 2) // ((big - 1) * (big + 3))


def test_collocations_of_awkward_texts(spark):
    df = documents(spark)
    got = [tuple(r) for r in collocations.collocations(df, least=6).select(*COLUMNS).collect()]
    assert sorted(got) == sorted(plain_phrases([(r[2], r[1]) for r in rows()], 6))
    assert collocations.collocations(empty(spark)).count() == 0


# ------------------------------------------------------------------ conversation trie
def plain_trie(found):
    turns = defaultdict(list)
    for c, turn, role, text in found:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    made = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        made[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids, out = defaultdict(int), {}
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(made[c]) == len(p))))
        out[p] = (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())
    return Counter(out.values())


TRIE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
TURN = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                     T.StructField("depth", T.StringType()), T.StructField("a", T.StringType()), T.StructField("idx", T.StringType())])


def trie_of(spark, found, parts=7):
    df = spark.createDataFrame([(*r, "clash", "a", "i") for r in found], TURN).repartition(parts)
    return Counter(tuple(r) for r in conversation_trie.trie(df).select(*TRIE).collect())


def test_trie_equals_plain_version(spark):
    rng = random.Random(8)
    say = lambda: rng.choice(["hi", "héllo 日本", "", None, "x" * 40000])
    found = []
    for c in [*rng.sample(range(0, 900), 90), 0, 100, -100, -137, -3]:
        for t in range(rng.randint(1, 9)):
            found.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), say()))
    found += [(5000 + i, t, "user", f"common {t}") for i in range(60) for t in range(8)]  # one conversation many times
    found += found[:40]  # repeated rows
    found += [(None, 1, "user", "nobody"), (7101, None, None, None)]
    assert trie_of(spark, found) == plain_trie(found)


def test_long_chains_and_a_hot_conversation(spark):
    found = [(4242, t, "user", str(t % 5)) for t in range(700)]
    found += [(9900 + i, t, "user", str(t % 5)) for i in range(3) for t in range(200 + 50 * i)]
    found += [(20000 + i, 0, "user", "hub") for i in range(30)] + [(20000 + i, 1, "user", str(i)) for i in range(30)]
    assert trie_of(spark, found, 4) == plain_trie(found)


def test_trie_of_little(spark):
    assert trie_of(spark, []) == Counter()
    assert trie_of(spark, [(None, 1, "user", "x")]) == Counter()
    for c in range(3, 9):  # some of them lose their only turn to the missing conversation 0, so only the root is left
        assert trie_of(spark, [(c, 1, "user", "x")]) == plain_trie([(c, 1, "user", "x")])
