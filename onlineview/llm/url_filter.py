"""URL filter: fixed site rules, then logistic regression on hashed character n-grams of host and path.

The regression learns from a small labelled URL table (url, label: 1 block, 0 allow). By
default that table is a bounded sample of the URLs that a rule decides.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule
and is judged by the regression's bias; very long urls are read whole; repeated rows get
equal results; a probability at the threshold blocks; other columns are never read; an empty
table gives an empty result. With one class or none in the labelled table the regression
allows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import learn
from .text import blob, mapped, segment_sum

#: Rule (host and start of path) and verdict; a rule fits its host and all subdomains, the longest fit wins.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: URLs learnt from, for each class.
PER_CLASS = 2000
BITS = 16
SIZE = 2 << BITS
_SIZES = (3, 4, 5)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    h = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(h, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(h: Column, p: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, else null."""
    fits = []
    for r in sorted(rules, key=len, reverse=True):
        site, slash, rest = r.partition("/")
        fits.append(F.when(((h == site) | h.endswith("." + site)) & p.startswith(slash + rest), F.lit(r)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def with_rules(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """page_id, url, host, path, rule, ruled (the rule's verdict, else null)."""
    h, p = host(F.col("url")), path(F.col("url"))
    out = pages.select("page_id", "url", h.alias("host"), p.alias("path"))
    out = out.withColumn("rule", rule(F.col("host"), F.col("path"), rules))
    ruled = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in rules.items()], F.lit(None).cast("string"))
    return out.withColumn("ruled", ruled)


def labelled_urls(pages: DataFrame, rules: dict[str, str] = RULES, per_class: int = PER_CLASS) -> DataFrame:
    """The default labelled table: at most ``per_class`` distinct URLs that the rules block, and as many that they allow."""
    decided = with_rules(pages, rules).filter(F.col("ruled").isNotNull()).select("url", (F.col("ruled") == "block").cast("int").alias("label")).distinct()
    parts = [decided.filter(F.col("label") == y).orderBy(F.xxhash64("url"), "url").limit(per_class) for y in (0, 1)]
    return parts[0].union(parts[1])


def _buckets(data: np.ndarray, size: int, block: int) -> np.ndarray:
    n = max(len(data) - size + 1, 0)
    acc = np.full(n, size, np.uint32)
    for j in range(size):
        acc = (acc ^ (data[j:j + n].astype(np.uint32) + np.uint32(1))) * np.uint32(0x01000193)
        acc ^= acc >> np.uint32(13)
    return (acc * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)).astype(np.int64) + (block << BITS)


def _marked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each text between \\x02 and \\x03, so that n-grams see beginnings and ends."""
    data, offs = blob(column)
    n = np.arange(len(offs))
    out = np.empty(len(data) + 2 * (len(offs) - 1), np.uint8)
    new = offs + 2 * n
    out[new[:-1]], out[new[1:] - 1] = 2, 3
    out[np.arange(len(data)) + np.repeat(2 * n[:-1] + 1, np.diff(offs))] = data
    return out, new


@dataclass
class UrlModel:
    w0: float
    w: np.ndarray | None

    def block(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        """Probability that each URL is to be blocked."""
        if self.w is None:
            return np.zeros(len(hosts))
        z = np.full(len(hosts), self.w0)
        for k, column in enumerate((hosts, paths)):
            data, offs = _marked(column)
            for size in _SIZES:
                sums = segment_sum(self.w[_buckets(data, size, k)].astype(float), offs, size - 1)
                z += sums / np.maximum(np.diff(offs) - size + 1, 1)
        return learn.sigmoid(z)


def fit(urls: DataFrame) -> UrlModel:
    """Learn from a labelled table (url, label), taken whole: it must be small."""
    def each(b):
        rows = [([], []) for _ in range(b.num_rows)]
        for k, column in enumerate((b.column(0), b.column(1))):
            data, offs = _marked(column)
            for size in _SIZES:
                bucket = _buckets(data, size, k)
                for i, r in enumerate(rows):
                    g = bucket[offs[i]:max(offs[i], offs[i + 1] - size + 1)]
                    if len(g):
                        f, c = np.unique(g, return_counts=True)
                        r[0].append(f)
                        r[1].append(c / len(g))
        none = np.zeros(0)
        return {"idx": pa.array([np.concatenate([none, *r[0]]).astype(np.int32).tobytes() for r in rows], pa.binary()),
                "val": pa.array([np.concatenate([none, *r[1]]).astype(np.float32).tobytes() for r in rows], pa.binary()), "y": b.column(2)}

    rows = urls.filter(F.col("label").isin(0, 1)).select(host(F.col("url")).cast("binary").alias("h"), path(F.col("url")).cast("binary").alias("p"), F.col("label").cast("int").alias("y"))
    got = sorted(mapped(rows, each, "idx binary, val binary, y int").collect(), key=lambda r: (r.y, r.idx, r.val))
    y = np.array([r.y for r in got], float)
    if not 0 < y.sum() < len(y):
        return UrlModel(0.0, None)
    w0, w, _ = learn.fit_machine(learn.Sparse.collect(got), y, SIZE, 0, epochs=6, lr=0.5, l2=1e-6)
    return UrlModel(w0, w)


def judge(pages: DataFrame, model: UrlModel, rules: dict[str, str] = RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, p_block, verdict for every row: the rule's verdict, else the regression's."""
    ruled = with_rules(pages, rules).select("page_id", F.col("host").cast("binary"), F.col("path").cast("binary"), "rule", "ruled")
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def each(b):
        p = shared.value.block(b.column(1), b.column(2))
        return {**{n: b.column(i) for i, n in enumerate(b.schema.names)}, "p_block": pa.array(p)}

    kind = dict(pages.dtypes)["page_id"]
    out = mapped(ruled, each, f"page_id {kind}, host binary, path binary, rule string, ruled string, p_block double")
    verdict = F.coalesce("ruled", F.when(F.col("p_block") >= threshold, "block").otherwise("allow"))
    return out.select("page_id", F.col("host").cast("string"), F.col("path").cast("string"), "rule", "p_block", verdict.alias("verdict"))
