"""Sharding, packing, secrets, URL rules, counting rules, line dedup and decontamination against brute force."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fixtures_llm as fx  # noqa: E402

from onlineview.llm import decontaminate, line_dedup, ngram_join, packing, quality_rules, secret_scan, sharding, url_filter  # noqa: E402

WORDS = re.compile("[^\x20\x09-\x0d]+")
SF = "/root/testdata/sf0.001"


def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("make", [fx.documents, real])
def test_sharding_counts_slots_and_home(spark, make):
    docs = make(spark)
    got = sharding.shard(docs).collect()
    src = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in src)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r.slot)
    counts = [len(by[s]) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    # only full shards turn keys away: with room for all, nobody moves
    moved = sum(r["shard"] != r.home for r in got)
    full = {s for s in range(8) if counts[s] >= len(got) / 8}
    assert all(r.home in full or counts[r.home] == min(counts) for r in got if r["shard"] != r.home)
    homes = Counter(r.home for r in got)
    # at the least what full shards cannot hold moves, and no more than twice that, as some pass a shard that fills later
    over = sum(max(0, homes[s] - counts[s]) for s in range(8))
    assert over <= moved <= 2 * over


def test_sharding_hot_text_is_split(spark):
    docs = spark.createDataFrame([(i, "same" if i % 3 else f"t{i}") for i in range(900)], "doc_id long, text string")
    got = sharding.shard(docs).collect()
    counts = Counter(r["shard"] for r in got)
    assert set(counts.values()) <= {112, 113}
    same = Counter(r["shard"] for r in got if r.doc_id % 3)
    assert len(same) >= 5  # overflow went on clockwise


def test_ring_plan_moves_little_when_a_shard_is_added():
    import random
    rng = random.Random(1)
    keys = sorted(rng.getrandbits(64) - (1 << 63) for _ in range(20000))

    def place(n):
        nodes = sharding.ring(n)
        counts = [0] * (len(nodes) + 1)
        for k in keys:
            counts[sum(1 for _ in ()) if False else __import__("bisect").bisect_left(nodes, (k, -1))] += 1
        out = [None] * len(keys)
        for a, b, s, _ in sharding.plan(nodes, counts, n):
            out[a:b] = [s] * (b - a)
        return out
    a, b = place(8), place(9)
    assert None not in a and sum(x != y for x, y in zip(a, b)) < 0.16 * len(keys)


def test_sharding_empty(spark):
    assert sharding.shard(fx.empty(spark)).count() == 0


@pytest.mark.parametrize("make", [fx.documents, real])
def test_packing_round_trip(spark, make):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer()[0])
    tok.encode_special_tokens = True
    docs = make(spark)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        want[(r.doc_id, tuple(tok.encode(r.text or "", add_special_tokens=False).ids + [0]))] += 1
    got = packing.pack(docs, with_ids=True).collect()
    for r in got:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    # pieces of one document lie one after the other in the stream of sequences
    stream = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    found, held = Counter(), []
    for r in stream:
        assert r.start == len(held)
        held += r.ids
        if len(held) == r.doc_tokens:
            found[(r.doc_id, tuple(held))] += 1
            held = []
    assert found == want
    size = defaultdict(int)
    for r in stream:
        assert r.offset == size[r.sequence_id]
        size[r.sequence_id] += r.length
    assert sorted(size) == list(range(len(size)))
    assert all(n == 1024 or n & (n - 1) == 0 for n in size.values())  # no padding at all
    assert packing.pack(fx.empty(spark)).count() == 0


def test_special_token_literals_are_their_ids(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer()[0])
    texts = ["see <|endoftext|> here", "<|endoftext|>", "a<|endoftext|>b and c", "  <|endoftext|> x\n", "no <|endoftext| here", "plain words"]
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), with_ids=True).orderBy("doc_id", "start").collect()
    ids = defaultdict(list)
    for r in got:
        ids[r.doc_id] += r.ids
    assert ids == {i: tok.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    assert ids[0] == [3826, 220, 50256, 994, 0]


def test_words_joined_have_the_ids_of_whole_texts():
    bpe = packing.ByteBpe(*packing.default_tokenizer())
    rng = random.Random(5)
    letters = "ab cé1 '\n\t ü,.\x85\xa0中 \u3000\nst日re <|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    texts += [" ".join("".join(rng.choice("abcdefgß'-.,0123456789\n") for _ in range(rng.randint(1, 12))) for _ in range(400)) for _ in range(50)]
    for text in texts + ["x" * 3000 + " y" * 3000]:
        assert bpe.encode(text) == bpe.ids(text), text
    assert bpe.words


def test_hilbert_is_a_curve():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = packing.hilbert(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        path = grid[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_neighbours_on_the_curve_are_alike(spark):
    docs = real(spark).select("doc_id", "text", "lang")
    got = packing.pack(docs).filter("start = 0").orderBy("sequence_id", "offset").collect()
    lang = {r.doc_id: r["lang"] for r in docs.collect()}
    same = np.mean([lang[a.doc_id] == lang[b.doc_id] for a, b in zip(got, got[1:])])
    base = sum(v * v for v in Counter(lang.values()).values()) / len(lang) ** 2
    assert same > base + 0.1


def brute_secrets(text):
    text = text or ""
    spans = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m[2]) >= 12:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


@pytest.mark.parametrize("make", [fx.documents, real])
def test_secret_base_spans(spark, make):
    docs = make(spark)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        s = brute_secrets(r.text)
        joined = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in s)
        want[(r.doc_id, *(sum(x[1] == k for x in s) for k in range(3)), hashlib.sha256(joined.encode()).hexdigest())] += 1
    got = secret_scan.scan(docs).collect()
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    for r in got:
        base = ",".join(x for x in r.spans.split(",") if x and not x.startswith("guess"))
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256
    assert secret_scan.scan(fx.empty(spark)).count() == 0


def test_guess_spans_are_added(spark):
    docs = spark.createDataFrame([(1, "é pwd: Tr0ub4dor&3xZq! and pwd=password2019 login=qwertyuiop auth=aaaaaaaaaaaa")], "doc_id long, text string")
    r = secret_scan.scan(docs).first()
    assert r.spans == "guess:7:22" and r.n_guess == 1


@pytest.mark.parametrize("text, values", [
    ("password: Grün-Wald#2981x.", ["Grün-Wald#2981x"]), ("é pwd=ab(c9$Kq2!x now", ["ab(c9$Kq2!x"]), ("pwd: x9$Kq2!, then", ["x9$Kq2!"]),
    ('{"password": "two, w0rds; [x]", "n": 1}', ["two, w0rds; [x]"]), ("f(pwd='a\"b,c#9Z', token=zQ9,$k#)", ['a"b,c#9Z', "zQ9,$k#"]),
    ("login=Xy9$kk!Q;token=abcdefghijklmnop", ["Xy9$kk!Q"]), ('auth: "bob password=Zq9$kk!Q token=abcdefghijklmnop"', ["Zq9$kk!Q"]),
    ("password: 秘密の合言葉です, pwd: İİ9$Kq2!", ["秘密の合言葉です", "İİ9$Kq2!"]), ('password="",pwd=abc', []), ("password=hello token: 1999", [])])
def test_whole_values_are_scored(spark, text, values):
    r = secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    spans = [x.split(":") for x in r.spans.split(",") if x.startswith("guess")]
    assert [text[int(a):int(b)] for _, a, b in spans] == values and r.n_guess == len(values)


def test_guess_cost_beyond_ascii():
    for text in ("Grün-Wald#2981x", "ääää", "пароль2019", "é1999-12-31é"):
        assert secret_scan.guess_cost(text, secret_scan.ranked())[0] == pytest.approx(brute_cost(text, secret_scan.ranked()), abs=1e-9), text


def brute_cost(text, words):
    """Least cost over every segmentation, each segment as the cheapest of the kinds."""
    from functools import cache
    import math
    per = secret_scan.char_cost(text)
    low = text.lower()

    def segment(i, j):
        s = low[i:j]
        best = per * (j - i)
        if s in words:
            best = min(best, math.log10(words[s] + 1) + (math.log10(2) if text[i:j] != s else 0))
        if secret_scan._DATE.fullmatch(text[i:j]):
            best = min(best, math.log10(365 * 200))
        if secret_scan._YEAR.fullmatch(text[i:j]):
            best = min(best, math.log10(200))
        for size in (1, 2, 3, 4):
            if j - i >= size + max(2, size) and all(s[k] == s[k - size] for k in range(size, j - i)):
                best = min(best, size * per + math.log10((j - i) / size))
        if j - i >= 3 and all(b in secret_scan._NEAR.get(a, ()) for a, b in zip(s, s[1:])):
            best = min(best, math.log10(secret_scan._KEYS) + (j - i - 1) * math.log10(2))
        return best

    @cache
    def least(j):
        return 0.0 if not j else min(least(i) + segment(i, j) + (math.log10(2) if i else 0) for i in range(j))
    return least(len(text))


def test_guess_cost_of_random_values():
    import random
    rng, words = random.Random(4), secret_scan.ranked()
    bits = ["pass", "the", "qwe", "rty", "2019", "1999-12-31", "aaa", "abab", "x", "K", "7", "!", "asdf", "word", "me"]
    for _ in range(150):
        text = "".join(rng.choices(bits, k=rng.randint(1, 6)))
        assert secret_scan.guess_cost(text, words)[0] == pytest.approx(brute_cost(text, words), abs=1e-9), text


def test_guess_cost_of_a_long_value_is_quick():
    import time
    for text in ("x" * 50000, "qwertyuiop" * 4000, "zX9k" * 10000):
        t = time.process_time()
        assert secret_scan.guess_cost(text, secret_scan.ranked())[0] > 0
        assert time.process_time() - t < 20


@pytest.mark.parametrize("text", ["password2019", "Tr0ub4dor&3xZq!", "qwertyuiop", "aaaa", "abcabcabc", "monkey1999-12-31x", "zX9kk2pQ7w", "admin1234asdf", "a", "WelcomeWelcome",
                                  "qwertyyyyyyuiop", "xaaaab", "20200101999", "01.02.2003", "abababababcabc", "1q2w3e4rdfghjkl"])
def test_guess_cost_is_the_minimum(text):
    words = secret_scan.ranked()
    cost, parts = secret_scan.guess_cost(text, words)
    assert cost == pytest.approx(brute_cost(text, words), abs=1e-9)
    assert [p[1] for p in parts] == [0] + [p[2] for p in parts][:-1] and parts[-1][2] == len(text)


def brute_rules(text):
    text = text or ""
    w = WORDS.findall(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if grams[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


@pytest.mark.parametrize("make", [fx.documents, real])
def test_rule_statistics(spark, make):
    docs = make(spark)
    got = quality_rules.judge(docs, quality_rules.Regression(0.0, None)).collect()
    want = Counter((r.doc_id, *brute_rules(r.text)) for r in docs.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert all(r.kept == (not r.base_failed) for r in got)
    assert quality_rules.judge(fx.empty(spark), quality_rules.Regression(0.0, None)).count() == 0


def brute_url(url):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = re.sub("[A-Z]", lambda m: m[0].lower(), rest[:n]), rest[n:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for r in url_filter.RULES:
        site, _, p = r.partition("/")
        if (host == site or host.endswith("." + site)) and path.startswith("/" + p) and len(r) > len(best or ""):
            best = r
    return host, path, best


def test_url_rules(spark):
    urls = [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("url").collect()]
    urls += [None, "", "http://", "net/x", "://NET/", "http://a.NET", "http://Example.net/en/1?x", "x://example.net/en", "http://fooexample.com/de/1",
             "http://a.example.com/de/x#y", "http://example.org/fr/?q=http://a.net/", "ftp://net?/a", "a\nb://q.org/fr/\nz", "http://É.org/fr/ü"]
    rows = [(i, u, "h", "v", "r") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string, rule string")
    model = url_filter.fit(url_filter.labelled_urls(pages))
    got = {r.page_id: r for r in url_filter.judge(pages, model).collect()}
    for i, u, *_ in rows:
        assert (got[i].host, got[i].path, got[i]["rule"]) == brute_url(u), u
        want = url_filter.RULES.get(got[i]["rule"])
        assert got[i].verdict == (want or ("block" if got[i].p_block >= 0.5 else "allow"))
    assert url_filter.judge(pages.limit(0), url_filter.fit(url_filter.labelled_urls(pages.limit(0)))).count() == 0


def test_url_model_learns_the_rules(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    decided = url_filter.with_rules(pages).filter("ruled is not null")
    model = url_filter.fit(url_filter.labelled_urls(pages.filter("page_id % 4 <> 2")))
    held = url_filter.judge(pages.filter("page_id % 4 = 2"), model).join(decided.select("page_id", "ruled"), "page_id").collect()
    assert np.mean([(r.p_block >= 0.5) == (r.ruled == "block") for r in held]) > 0.95


def brute_lines(docs, ratio, errors):
    pages = defaultdict(set)
    for r in docs:
        if r.text is not None:
            pages[r.source].add(r.text)
    count = Counter((s, line) for s, texts in pages.items() for t in texts for line in set(t.split("\n")) if line)
    bad = {k for k, n in count.items() if n > ratio * len(pages[k[0]]) + errors * math.sqrt(ratio * len(pages[k[0]]) + 1)}
    return [None if r.text is None else "\n".join(x for x in r.text.split("\n") if (r.source, x) not in bad) for r in docs]


@pytest.mark.parametrize("make", [fx.documents, real])
def test_line_dedup(spark, make):
    docs = make(spark)
    for ratio, errors in ((line_dedup.MAX_RATIO, line_dedup.ERRORS), (0.01, 1.0)):
        rows = docs.collect()
        want = Counter((*(r[c] for c in docs.columns if c != "text"), t) for r, t in zip(rows, brute_lines(rows, ratio, errors)))
        out = line_dedup.drop_boilerplate(docs, max_ratio=ratio, errors=errors)
        assert out.columns == docs.columns
        assert Counter((*(r[c] for c in docs.columns if c != "text"), r.text) for r in out.collect()) == want
    assert line_dedup.drop_boilerplate(fx.empty(spark)).count() == 0


@pytest.mark.parametrize("pages, kept, dropped", [(50, 2, 3), (500, 3, 4), (5000, 16, 17)])
def test_the_ratio_decides_at_every_host_size(spark, pages, kept, dropped):
    rows = [("host", "\n".join([f"page {i}", *["below"] * (i < kept), *["above"] * (i < dropped)])) for i in range(pages)]
    out = [r.text for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, "source string, text string")).collect()]
    assert sum("below" in t for t in out) == kept and not any("above" in t for t in out)


def test_licence_line_over_many_sites_and_in_a_hot_one_is_dropped(spark):
    licence, copied = "Licensed under the Apache License, Version 2.0.", "a line that only two near copies share"
    rows = [("hot", f"page {i}\n{licence}" if i % 150 == 0 else f"page {i}") for i in range(3000)]
    rows += [(f"site{s}", "\n".join([f"page {s} {i}", *[licence] * (i < 4), *[copied] * (i in (7, 8))])) for s in range(10) for i in range(200)]
    out = [r.text for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, "source string, text string")).collect()]
    assert sum(licence in t for _, t in rows) == 60 and not any(licence in t for t in out)
    assert sum(copied in t for t in out) == 20 and sorted(t.split("\n")[0] for t in out) == sorted(t.split("\n")[0] for _, t in rows)


NORMAL = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def fold(t):
    return NORMAL.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_hits(docs, items):
    win = defaultdict(set)
    for name, text in items:
        w = fold(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1) if n else ():
            win[tuple(w[k:k + n])].add(name)
    sizes = {len(x) for x in win}
    out = Counter()
    for d, text in docs:
        w, hit, found = fold(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if names := win.get(tuple(w[k:k + n])):
                    hit |= set(range(k, k + n))
                    found |= names
        found = sorted(str(x) for x in found if x is not None)
        out[(d, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w))] += 1
    return out


@pytest.mark.parametrize("part_bytes", [8 << 20, 600])
@pytest.mark.parametrize("make", [fx.documents, real])
def test_decontamination(spark, make, part_bytes):
    docs = make(spark)
    src = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    long = max((t or "" for _, t in src), key=len).split()
    items += [(1000, " ".join(long[5:30])), (1001, "a"), (1001, "A, a!"), (None, " ".join(long[3:40])), (7, None), (8, ""), (1002, "?!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.digest(decontaminate.scan(docs, bench, part_bytes=part_bytes)).collect()
    want = brute_hits(src, items)
    assert Counter(tuple(r) for r in got) == want
    kept = decontaminate.keep_clean(docs, bench, part_bytes=part_bytes)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k[0] for k, n in want.items() if not k[-1] for _ in range(n))


def test_one_part_of_the_benchmark_is_held_at_a_time(spark, monkeypatch):
    from pyspark import SparkContext
    from pyspark.core.broadcast import Broadcast
    live, most, make, drop = [], [], SparkContext.broadcast, Broadcast.destroy

    def broadcast(self, value):
        live.append(make(self, value))
        most.append(len(live))
        return live[-1]

    def destroy(self, blocking=False):
        live.remove(self)
        drop(self, blocking)
    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    monkeypatch.setattr(Broadcast, "destroy", destroy)
    docs, bench = real(spark).limit(50), spark.read.parquet(f"{SF}/benchmark.parquet").limit(12)
    for call in (decontaminate.scan, decontaminate.keep_clean):
        assert call(docs, bench, part_bytes=600).count() <= 50
    assert len(most) >= 4 and set(most) == {1} and not live


def test_decontamination_spans_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "É x; Alpha-beta (GAMMA) ñ alpha beta gamma!")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "alpha beta gamma")], "item_id long, text string")
    r = decontaminate.scan(docs, bench).first()
    text = "É x; Alpha-beta (GAMMA) ñ alpha beta gamma!"
    assert [text[s.start:s.end] for s in r.spans] == ["Alpha-beta (GAMMA", "alpha beta gamma"]
    assert decontaminate.digest(decontaminate.scan(docs, bench.limit(0))).first().n_hit == 0
    assert decontaminate.scan(docs.limit(0), bench).count() == 0


def test_regular_long_words_have_different_hashes():
    """Thue-Morse words, which polynomial hashes modulo 2^64 cannot tell from their complements."""
    from onlineview.llm.text import Words
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
        other = word.translate(str.maketrans("ab", "ba"))
        data = np.frombuffer(f"{word} {other} {word}".encode(), np.uint8)
        h = Words(data, np.array([0, len(data)])).hash
        assert h[0] == h[2] != h[1]


def test_keep_one_takes_the_least_of_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, f"s{k}") for k in (5, 3, 4)] + [(2, "other words here", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __d string").repartition(3)
    assert sorted(tuple(r) for r in ngram_join.keep_one(df).collect()) == [(1, text, "s3"), (2, "other words here", "a")]


def test_secrets_among_prose_and_references(spark):
    rng = np.random.default_rng(3)
    words = "required recommended forgiveness disabled experts settings because yesterday mountain river letters number people".split()
    corpus = [" ".join(rng.choice(words, 40)) for _ in range(50)]
    chars = np.array(list("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789!#%*"))
    planted = ["".join(rng.choice(chars, 10)) for _ in range(40)]
    forms = ["password: {}", "pwd={}", "Authorization: Bearer {}", "api_key = '{}'", "login: https://me:{}@host/x"]
    plain = [f"{name}: {w}" for name in ("password", "secret", "auth") for w in words] + [
        "password: ${DB_PASSWORD}", 'api_key = os.environ["KEY"]', "secret = get_secret('db')", "login: https://example.com/start", "token: <your token>",
        "password: {{ vault.password }}", "pwd=$PASSWORD", "auth: %USER%"]
    rows = corpus + [forms[i % 5].format(p) for i, p in enumerate(planted)] + plain
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    listed = secret_scan.corpus_words(df)
    assert set(words) <= set(listed) and listed == sorted(listed, key=lambda w: (-sum(w in re.findall("[a-z]{3,24}", t.lower()) for t in rows), w))
    got = {r.doc_id for r in secret_scan.scan(df, (*secret_scan.WORDS, *listed)).filter("n_guess + n_assign > 0").collect()}
    want = set(range(50, 90))
    assert len(got & want) >= 39 and not got - want  # recall and precision
    assert secret_scan.corpus_words(df.limit(0)) == []
