"""Verification of the online store against the snapshot it should hold.

Everything is a distributed comparison: one full outer join on ``key`` between
expected records and stored records, then field-wise map comparison inside
the joined row. Only the final per-status counts (at most four rows) reach the
driver, for the PASS/FAIL gate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .encode import FIELDS, KEY

STATUSES = ("missing", "extra", "changed", "same")


class ReconciliationError(RuntimeError):
    """The online store does not hold what the snapshot says it should."""


def _mismatched(exp: Column, got: Column, strict: bool) -> Column:
    """Names of fields whose text differs (null-safe).

    strict: every field present on either side must agree. lenient: only
    fields with a non-null expected value are checked (extra stored fields
    and stale values of now-null fields are ignored).
    """
    names = F.array_union(F.map_keys(exp), F.map_keys(got)) if strict else F.map_keys(exp)
    return F.array_sort(F.filter(names, lambda k: ~F.element_at(exp, k).eqNullSafe(F.element_at(got, k))))


def diff(expected: DataFrame, stored: DataFrame, strict: bool = True) -> DataFrame:
    """Per key: status in missing / extra / changed / same, plus mismatched field names."""
    e = expected.select(F.col(KEY), F.col(FIELDS).alias("e"))
    s = stored.select(F.col(KEY), F.col(FIELDS).alias("s"))
    j = e.join(s, KEY, "full_outer")
    bad = _mismatched(F.col("e"), F.col("s"), strict)
    status = (F.when(F.col("s").isNull(), "missing")
               .when(F.col("e").isNull(), "extra")
               .when(F.size(bad) > 0, "changed")
               .otherwise("same"))
    fields = F.when(F.col("e").isNotNull() & F.col("s").isNotNull(), bad) \
        .otherwise(F.array().cast("array<string>"))
    return j.select(F.col(KEY), status.alias("status"), fields.alias("mismatched_fields"),
                    F.size(fields).cast("long").alias("n_mismatched"))


def digest_diff(spark: SparkSession, expected: DataFrame, root: str, group: str, strict: bool = True) -> tuple[DataFrame, set[int]]:
    """:func:`diff` against the online table over the buckets whose digests differ from the expected ones, and those buckets.

    The version table knows the digest of a bucket without change sets; one with some is compared in full.
    """
    from ..sinks import online_table as OT
    at = OT.state(spark, root, group)
    if not at.number:
        raise FileNotFoundError(f"no committed online table under {root} for group {group!r}")
    bucket = OT.bucket_of(KEY, len(at.buckets))
    known = {r["bucket"]: (r["keys"], (r["h1"], r["h2"])) for r in  # one row for each bucket
             OT.digests(expected.withColumn("bucket", bucket), "bucket").collect()}
    opened = {k for k, b in enumerate(at.buckets) if b.digests is None or (b.keys, b.digests) != known.get(k, (0, (0, 0)))}
    stored = OT.read_online(spark, root, group, check_ttl=False, buckets=opened, at=at)
    return diff(expected.filter(bucket.isin(sorted(opened))), stored, strict), opened


def summary(d: DataFrame) -> DataFrame:
    """Mismatch counters: keys per status and mismatched fields per status."""
    return d.groupBy("status").agg(F.count("*").alias("keys"),
                                   F.sum("n_mismatched").cast("long").alias("fields"))


def count_check(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Expected vs stored key counts in one row (one global aggregate over a union)."""
    a = expected.select(F.lit(1).alias("x"), F.lit(0).alias("y"))
    b = stored.select(F.lit(0).alias("x"), F.lit(1).alias("y"))
    return (a.unionByName(b)
             .agg(F.sum("x").cast("long").alias("expected"), F.sum("y").cast("long").alias("stored"))
             .withColumn("ok", F.col("expected") == F.col("stored")))


def _draw(salt: str) -> Column:
    return F.md5(F.concat(F.lit(salt), F.col(KEY)))


def sample_keys(df: DataFrame, n: int, salt: str = "") -> DataFrame:
    """Deterministic pseudo-random sample of ``n`` keys: order by md5(salt+key), key.

    A top-n per task then one merge of at most n rows per task; the sample
    size is the feature, not a cost cap.
    """
    return df.select(KEY).orderBy(_draw(salt), F.col(KEY)).limit(n)


def sampled_diff(expected: DataFrame, stored: DataFrame, n: int, salt: str = "",
                 strict: bool = True) -> DataFrame:
    """Read-back check of ``n`` sampled expected keys (missing ones count as mismatches)."""
    keys = sample_keys(expected, n, salt)
    e = expected.join(keys, KEY, "left_semi")
    s = stored.join(keys, KEY, "left_semi")
    return diff(e, s, strict).filter(F.col("status") != "extra")


def stale_keys(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored keys that the snapshot no longer has (e.g. tombstoned since)."""
    return stored.select(KEY).join(expected.select(KEY), KEY, "left_anti")


def missing_keys(expected: DataFrame, stored: DataFrame) -> DataFrame:
    return expected.select(KEY).join(stored.select(KEY), KEY, "left_anti")


@dataclass(frozen=True)
class Report:
    expected: int
    stored: int
    counts: dict
    sample_size: int
    sample_mismatches: int

    @property
    def count_ok(self) -> bool:
        return self.expected == self.stored

    @property
    def ok(self) -> bool:
        bad = sum(self.counts.get(s, 0) for s in ("missing", "extra", "changed"))
        return self.count_ok and bad == 0 and self.sample_mismatches == 0

    def lines(self) -> list[str]:
        verdict = lambda b: "ok" if b else "MISMATCH"
        return [
            f"keys: {self.expected} in the snapshot, {self.stored} stored: {verdict(self.count_ok)}",
            f"read-back of {self.sample_size} keys, {self.sample_mismatches} differ: {verdict(self.sample_mismatches == 0)}",
            "all keys by status: " + ", ".join(f"{s} {self.counts.get(s, 0)}" for s in STATUSES),
        ]


def report(expected: DataFrame, stored: DataFrame, sample: int = 25, strict: bool = True,
           salt: str = "") -> Report:
    """Count check, full diff and sampled check, reduced to a handful of numbers.

    The sample is drawn from the diff itself, so expected and stored records are
    compared once; the diff is kept for both uses and recomputed if lost.
    """
    d = diff(expected, stored, strict).select(KEY, "status", "n_mismatched").persist()
    try:
        counts = {r["status"]: r["keys"] for r in summary(d).collect()}
        drawn = d.filter(F.col("status") != "extra").orderBy(_draw(salt), F.col(KEY)).limit(sample)
        srow = drawn.agg(F.count("*").alias("n"), F.count_if(F.col("status") != "same").alias("bad")).first()
    finally:
        d.unpersist()
    exp_n = sum(counts.get(s, 0) for s in ("missing", "changed", "same"))
    got_n = sum(counts.get(s, 0) for s in ("extra", "changed", "same"))
    return Report(exp_n, got_n, counts, int(srow["n"]), int(srow["bad"]))


def gate(r: Report) -> Report:
    """Raise on any mismatch (the job's non-zero exit)."""
    if not r.ok:
        raise ReconciliationError("; ".join(r.lines()))
    return r
