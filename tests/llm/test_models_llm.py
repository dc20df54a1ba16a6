"""N-gram join against brute force; learnt operators on held-out labels."""

import os
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fixtures_llm as fx  # noqa: E402

from onlineview.llm import learn, ngram_join, quality_fm, quality_rules, toxicity  # noqa: E402
from onlineview.llm.text import SPACE, Words, blob, windows  # noqa: E402

SF = "/root/testdata/sf0.001"
BIG = "/root/testdata/sf0.1"


def words(t):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def shingles(t, k):
    w = words(t)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i
    order = sorted((i for i in range(len(rows)) if sets[i]), key=lambda i: len(sets[i]))
    for p, i in enumerate(order):
        for j in order[p + 1:]:
            if num * len(sets[j]) > den * len(sets[i]):
                break
            both = len(sets[i] & sets[j])
            if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if sets[i]:
            ids[find(i)].append(d)
    least = {c: min((x for x in v if x is not None), default=None) for c, v in ids.items()}
    return [(d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)], [find(i) if sets[i] else None for i in range(len(rows))]


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100)])
@pytest.mark.parametrize("make", [fx.documents, lambda s: s.read.parquet("/root/testdata/sf0.01/documents.parquet")])
def test_join_components(spark, make, k, num, den):
    docs = make(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want, group = brute_components(rows, k, num, den)
    got = ngram_join.join(docs, k, num, den).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(tuple(r) for r in got) == Counter(want)
    kept = ngram_join.keep_one(docs, k, num, den)
    assert kept.columns == docs.columns
    texts = Counter((r.doc_id, r.text) for r in kept.collect())
    groups = defaultdict(list)
    for row, g in zip(rows, group):
        groups[g].append(row)
    for row in groups.pop(None, []):
        texts[row] -= 1
    for members in groups.values():  # exactly one of each group
        here = {m for m in members if texts[m] > 0}
        assert len(here) == 1
        texts[here.pop()] -= 1
    assert not +texts and not -texts


def test_join_chain_and_hot_group(spark):
    """Copies that link only through others, a group of many near copies, and pairs just under the threshold."""
    import random
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(30):  # a chain: neighbours differ in one place
        base = list(base)
        base[(i * 7) % 120] = f"c{i}"
        rows.append((100 - i, " ".join(base)))
    hub = [f"h{rng.randrange(10**6)}" for _ in range(100)]
    for i in range(400):
        copy = list(hub)
        for _ in range(rng.choice((1, 1, 2, 3))):
            copy[rng.randrange(100)] = f"e{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(copy)))
    for n in range(9, 25):  # small sets on both sides of the threshold
        t = [f"s{n}x{j}" for j in range(n)]
        rows += [(3000 + 10 * n, " ".join(t)), (3001 + 10 * n, " ".join(t + ["z"])), (3002 + 10 * n, " ".join(t[:-2]))]
    want, _ = brute_components(rows, 3, 90, 100)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(tuple(r) for r in ngram_join.join(docs).select("doc_id", "n_shingles", "component_id").collect()) == Counter(want)


def test_few_rows_without_a_key_pass_to_the_join(spark):
    from pyspark.sql import functions as F

    from onlineview.llm import tables
    df = spark.range(100_000).select("id", F.when(F.col("id") % 1000 != 7, F.col("id") * 3).alias("b"), F.lit(1).alias("map_words"))
    for step in (1, 50, 4000):
        keys = df.filter(F.col("id") % step == 0).select("id", "b")
        got = tables.narrowed(df, ["id", "b"], keys)
        assert got.columns == df.columns and keys.exceptAll(got.select("id", "b")).isEmpty()
        assert got.count() - keys.count() < 100_000 / 12
    assert tables.narrowed(df, ["id"], keys.limit(0).select("id")).isEmpty()


def test_join_shuffles_no_unwanted_texts_and_keys(spark, monkeypatch):
    """Rows that reach the joins of class_sets and shared_keys: those of few documents with a near copy."""
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    docs = spark.createDataFrame([(i, text(i)) for i in range(2000)] + [(5000, text(7) + " end")], "doc_id long, text string").repartition(4)
    passed, narrow = [], ngram_join.narrowed
    monkeypatch.setattr(ngram_join, "narrowed", lambda df, by, keys: passed.append((df.count(), narrow(df, by, keys).count())) or narrow(df, by, keys))
    got = {r.doc_id: r.component_id for r in ngram_join.join(docs).collect()}
    assert got[5000] == 7 and len(set(got.values())) == 2000
    assert len(passed) > 1 and all(few < rows / 8 for rows, few in passed)


def test_join_empty(spark):
    assert ngram_join.join(fx.empty(spark)).count() == 0
    assert ngram_join.keep_one(fx.empty(spark)).count() == 0


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100), (1, 2)])
def test_keys_are_never_missed(num, den):
    """Any two sets that link share a key, whatever their sizes; the bitmap bound never rejects a link."""
    tiles = ngram_join.Tiles(num, den)
    rng = np.random.default_rng(0)
    linked = 0
    for _ in range(1500):
        n = int(rng.integers(1, 160))
        a = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
        drop = int(rng.integers(0, max(1, n // 3) + 1))
        add = int(rng.integers(0, max(1, n // 3) + 1))
        b = np.concatenate((a[drop:], rng.integers(0, 2**63, add).astype(np.uint64) * np.uint64(2)))
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if not len(b) or np.array_equal(a, b) or den * both < num * (len(a) + len(b) - both):
            continue
        linked += 1
        assert set(ngram_join.keys_of(a, tiles)) & set(ngram_join.keys_of(b, tiles))
        differ = ngram_join.differing([ngram_join.bitmap(a).tobytes()], [ngram_join.bitmap(b).tobytes()])
        assert ngram_join.may_link(len(a), len(b), differ, tiles).all()
    assert linked > 30


@pytest.mark.parametrize("size", [50, 120, 189, 242, 294, 377, 460, 1000, 2734])
def test_sets_that_share_nothing_share_no_key(size):
    rng, tiles = np.random.default_rng(size), ngram_join.Tiles(80, 100)
    keys = [k for _ in range(30) for k in ngram_join.keys_of(np.unique(rng.integers(0, 1 << 64, size, np.uint64)), tiles)]
    assert len(set(keys)) == len(keys)


def test_shared_keys_are_those_of_two_classes(spark):
    tiles, texts = ngram_join.Tiles(80, 100), [" ".join(f"w{i * (j % 97 == 5 and d or 1)}" for j, i in enumerate(range(1, 300))) for d in (1, 7, 11)]
    sets = {t: next(ngram_join.shingle_sets(ngram_join.pa.array([t.encode()]), 5)) for t in (*texts, "one two three four five six seven eight")}
    by = defaultdict(set)
    for s in sets.values():
        for key in ngram_join.keys_of(s, tiles):
            by[int(key.view(np.int64))].add(ngram_join._class(s))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*sets] * 40)], "doc_id long, text string").repartition(5)
    got = Counter((r.key, r.cls) for r in ngram_join.shared_keys(ngram_join.documents(docs, 5, tiles)).collect())
    assert got == Counter((k, c) for k, found in by.items() if len(found) > 1 for c in found) and got


def test_word_hashes_do_not_depend_on_the_batch():
    import pyarrow as pa
    texts = ["alpha beta", "", None, "beta gamma  alpha", "x" * 70000 + " alpha", "y " * (1 << 20) + "beta", "beta"]
    data, offs = blob(pa.array([None if t is None else t.encode() for t in texts], pa.binary()))
    w = Words(data, offs, SPACE)
    h = w.hash
    assert [data[a:b].tobytes().decode() for a, b in zip(w.st[:5], w.en[:5])] == ["alpha", "beta", "beta gamma", "alpha", "x" * 70000]
    assert h[0] == h[3] and h[1] == h[-1] == h[-2] and len(set(h.tolist())) == 5
    assert w.count.tolist() == [2, 0, 0, 2, 2, (1 << 20) + 1, 1]
    at, sh = windows(w, h, 2)
    assert len(at) == 3 + (1 << 20) and sh[0] != sh[1]


def held(spark, target):
    docs, labels = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")
    truth = {r.doc_id: r[target] for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    return docs, labels, truth


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_quality_machine_on_held_out_labels(spark):
    docs, labels, truth = held(spark, "quality")
    model = quality_fm.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality_fm.score(docs, model).collect()}
    s, y = (np.array(v) for v in zip(*((got[d], t) for d, t in truth.items())))
    print("auc", auc(s, y), "clean kept", (s[y == 1] >= 0.7).mean(), "junk out", (s[y == 0] < 0.7).mean())
    assert auc(s, y) > 0.97 and (s[y == 1] >= 0.7).mean() > 0.97 and (s[y == 0] < 0.7).mean() > 0.85
    kept = quality_fm.keep(docs, model)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d for d, x in got.items() if x >= 0.7}


def test_quality_machine_edges(spark):
    docs, labels, _ = held(spark, "quality")
    model = quality_fm.fit(docs, labels.limit(0))
    assert {r.score for r in quality_fm.score(fx.documents(spark), model).collect()} == {0.5}
    assert quality_fm.keep(fx.documents(spark), model).count() == len(fx.rows())
    one = quality_fm.fit(docs, labels.filter("quality = 1"))
    assert one.w is None and learn.sigmoid(one.w0) > 0.9
    model = quality_fm.fit(docs, labels)
    got = quality_fm.score(fx.documents(spark), model)
    assert got.count() == len(fx.rows()) and all(0 <= r.score <= 1 for r in got.collect())
    assert quality_fm.score(fx.empty(spark), model).count() == 0
    assert quality_fm.keep(fx.documents(spark), model).columns == fx.SCHEMA.names


def test_machine_score_is_the_pairwise_sum():
    """The linear-time score equals the sum over all pairs."""
    rng = np.random.default_rng(1)
    model = quality_fm.QualityFM(0.3, rng.normal(size=quality_fm.SIZE).astype(np.float32), rng.normal(0, 0.3, (quality_fm.SIZE, 4)).astype(np.float32))
    import pyarrow as pa
    text = "One two two THREE #4 four | five".encode()
    x = quality_fm.features(*blob(pa.array([text], pa.binary())))
    z = model.w0 + sum(model.w[i] * v for i, v in zip(x.idx, x.val))
    for p in range(len(x.idx)):
        for q in range(p):
            z += float(model.v[x.idx[p]] @ model.v[x.idx[q]]) * x.val[p] * x.val[q]
    assert model.score(pa.array([text], pa.binary()))[0] == pytest.approx(learn.sigmoid(z), rel=1e-4)


def test_quality_rules_on_held_out_labels(spark):
    docs, labels, truth = held(spark, "quality")
    model = quality_rules.fit(docs, labels)
    rows = {r.doc_id: r for r in quality_rules.judge(docs, model).collect()}
    p, y = (np.array(v) for v in zip(*((rows[d].probability, t) for d, t in truth.items() if not rows[d].base_failed)))
    print("auc", auc(p, y), "clean kept", (p[y == 1] >= 0.5).mean(), "junk out", (p[y == 0] < 0.5).mean())
    assert auc(p, y) > 0.95 and (p[y == 1] >= 0.5).mean() > 0.97
    assert abs(p.mean() - y.mean()) < 0.05  # calibrated
    assert quality_rules.fit(docs, labels.limit(0)).w is None


def test_toxicity_on_held_out_labels(spark):
    docs, labels, truth = held(spark, "toxic")
    model = toxicity.fit(docs, labels)
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    s, flag, y = (np.array(v) for v in zip(*((rows[d].expected_severity, rows[d].toxic, t) for d, t in truth.items())))
    print("auc", auc(s, y), "caught", flag[y == 1].mean(), "clean flagged", flag[y == 0].mean())
    # a fifteenth of the toxic texts here hold no toxic word at all
    assert auc(s, y) > 0.97 and flag[y == 1].mean() > 0.9 and flag[y == 0].mean() < 0.01
    assert (np.diff(model.theta) > 0).all()
    assert all(0 <= r.expected_severity <= 3 and (r.grade > 0) == r.toxic for r in rows.values())
    got = toxicity.score(fx.documents(spark), model)
    assert got.count() == len(fx.rows()) and toxicity.score(fx.empty(spark), model).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert {(r.expected_severity, r.toxic) for r in toxicity.score(fx.documents(spark), none).collect()} == {(0.0, False)}


def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = fx.documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for d in (docs, docs.limit(0)):
            out = stage(spark, d, SF)
            assert out.columns == d.columns, name
            out.count()
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns
