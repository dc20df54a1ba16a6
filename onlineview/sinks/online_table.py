"""The online table: versioned, hash-bucketed Parquet storage of encoded records.

Layout, per feature group::

    root/data/feature_group=<g>/write=<id>/bucket=<b>/part-*.parquet
    root/versions/feature_group=<g>/version=<n>/part-*.parquet     (one row for each bucket)

Records live in bucket ``pmod(xxhash64(key), buckets)``; the bucket count is a stored
property of the group. Every write puts its files into a folder of its own (the id is
unique to the writer) and then publishes one small version table that names, for each bucket, the write that
holds its records (``base``), the change sets on top of it (``deltas``, by the version that
added them) and what is known of its content. Readers take the highest version, so they see a group
before or after a write, never in between, and nothing that is read is overwritten.

Several writers may work on one group. A version is published by renaming a finished folder, which fails if
another writer was first; the loser then looks at what has changed since it started. If its buckets were left alone
it publishes on top of the winner, else it raises :class:`CommitConflict` and leaves the winner's version as it is.
Change sets never conflict, as they are added on top. (The rename must be atomic, as on HDFS.)

* ``write_online(mode="replace")`` -- the group becomes exactly the new snapshot, empty ones included.
* ``write_online(mode="merge")`` -- like a key-value store's field-wise upsert: new non-null fields
  overwrite, other keys and fields stay. The buckets it touches are rewritten.
* :func:`apply_changes` -- whole records are upserted and keys deleted. Only those keys are written; reads take
  the newest record of each key, and :func:`compact` folds change sets into the buckets.
* :func:`sweep` -- rewrites the buckets whose lowest deadline has passed, without their expired records.

Beside the field map, files hold each contract feature as a typed column (``f_<name>``: double
for NUMERIC, text for TAG), made from the map whenever a bucket is written. A read that names
its contract gets them, so that aggregates read only the columns they use and push filters down. Files are sorted
by key and carry a Bloom filter of it, sized by the keys it holds, so a point read skips row groups that cannot hold the key.

A stored record whose deadline has passed counts as absent in merge and in reads. Versions
and files stay for ``retain`` seconds after they were replaced, for the readers that still use them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.text import parse_number
from ..operators.encode import DOC, FIELDS, KEY, TYPED, doc_column, field_value, fields_column, online_key
from ..session import adaptive

GROUP = "feature_group"
ENTITY = "entity"
WRITTEN_AT = "written_at"
EXPIRES_AT = "expires_at"
BUCKET = "bucket"
WRITE = "write"
VERSION = "version"
GONE = "gone"
DIGESTS = ("h1", "h2")

ONLINE_COLUMNS = (KEY, ENTITY, FIELDS, DOC, WRITTEN_AT, EXPIRES_AT)


def _data_schema(typed: Contract | None = None) -> str:
    own = [f"`{TYPED}{n}` {'double' if k == 'NUMERIC' else 'string'}" for n, k in _typed(typed)] if typed else []
    return ", ".join([f"{KEY} string, {ENTITY} string, {FIELDS} map<string,string>, {DOC} string, {WRITTEN_AT} timestamp, "
                      f"{EXPIRES_AT} timestamp", *own, f"{GONE} boolean, h1 long, h2 long, {GROUP} string, {WRITE} string, {BUCKET} int"])


def _typed(c: Contract) -> list[tuple[str, str]]:
    return [(c.entity_column, "TAG")] + [(n, k) for n, k in c.features if n != c.entity_column]


def _with_typed(recs: DataFrame, c: Contract) -> DataFrame:
    text = {n: field_value(n) for n, _ in _typed(c)}
    return recs.select(*ONLINE_COLUMNS, GONE, *[digest(k + 1).alias(h) for k, h in enumerate(DIGESTS)], *[(parse_number(text[n]) if k == "NUMERIC" else text[n]).alias(TYPED + n)
                                          for n, k in _typed(c)])


#: Buckets of a new group. Choose so that one bucket is a few hundred MB at most.
DEFAULT_BUCKETS = 16
#: Seconds for which replaced versions and their files stay readable.
RETAIN = 3600
#: Change sets on a bucket from which the refresh stream folds them in.
COMPACT_AFTER = 8
#: Filters are tried in ten sizes, from 1 MB down, of which each row group keeps the smallest that fits its keys.
_BLOOM = {"parquet.bloom.filter.enabled#key": "true", "parquet.bloom.filter.adaptive.enabled": "true",
          "parquet.bloom.filter.candidates.number#key": "10"}


def records(snapshot: DataFrame, c: Contract, *, mode: str = "contract", keep_metadata: bool = False,
            with_doc: bool = False, ttl_anchor: str = "write", written_at: datetime | None = None,
            exact_floats: bool = True) -> DataFrame:
    """Encode a snapshot into online-table rows (no write).

    ``ttl_anchor='write'`` counts the TTL from the write clock (what a
    key-value EXPIRE does); ``'event'`` counts it from the record's event time
    (a freshness budget per feature group).
    """
    now = F.lit(written_at).cast("timestamp") if written_at else F.current_timestamp()
    doc = doc_column(snapshot, c, mode, keep_metadata) if with_doc else F.lit(None).cast("string")
    if c.ttl_seconds > 0:
        anchor = now if ttl_anchor == "write" else F.col(c.event_time_column).cast("timestamp")
        expires = anchor + F.make_dt_interval(secs=F.lit(c.ttl_seconds))
    else:
        expires = F.lit(None).cast("timestamp")
    return snapshot.select(online_key(c).alias(KEY), F.col(c.entity_column).cast("string").alias(ENTITY),
                           fields_column(snapshot, c, mode, keep_metadata, exact_floats).alias(FIELDS),
                           doc.alias(DOC), now.alias(WRITTEN_AT), expires.alias(EXPIRES_AT))


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key) if isinstance(key, str) else key), F.lit(buckets)).cast("int")


def _alive(clock: datetime | str | None) -> Column:
    now = F.current_timestamp() if clock is None else F.to_timestamp(F.lit(clock)) \
        if isinstance(clock, str) else F.lit(clock).cast("timestamp")
    return F.col(EXPIRES_AT).isNull() | (F.col(EXPIRES_AT) > now)


def overlay_fields(old: Column, new: Column) -> Column:
    """Field-wise upsert of two maps: new values win, other old fields stay."""
    keep_old = F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(keep_old, new)


def merge_records(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merge-mode result of writing ``new`` over live ``old`` records (one full outer join on key).

    A written key takes document, times and deadline from the new record.
    """
    o = old.select(*[F.col(x).alias(f"o_{x}") for x in ONLINE_COLUMNS])
    n = new.select(*ONLINE_COLUMNS)
    j = o.join(n, o[f"o_{KEY}"] == n[KEY], "full_outer")
    written, both = F.col(KEY).isNotNull(), F.col(KEY).isNotNull() & F.col(f"o_{KEY}").isNotNull()
    pick = {x: F.when(written, F.col(x)).otherwise(F.col(f"o_{x}")) for x in ONLINE_COLUMNS}
    pick[FIELDS] = F.when(both, overlay_fields(F.col(f"o_{FIELDS}"), F.col(FIELDS))).otherwise(pick[FIELDS])
    return j.select(*[pick[x].alias(x) for x in ONLINE_COLUMNS])


def _utc(ts: Column) -> Column:
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def digest(number: int) -> Column:
    """64-bit digest of a record's key and fields, whatever the order of its map."""
    return F.xxhash64(F.lit(number), F.col(KEY), F.array_sort(F.map_entries(FIELDS)))


def digests(records: DataFrame, *by: str) -> DataFrame:
    """Count and order-free digests of the records in each group of ``by``."""
    return records.groupBy(*by).agg(F.count(F.lit(1)).alias("keys"), *[F.bit_xor(digest(k + 1)).alias(h) for k, h in enumerate(DIGESTS)])


# ----------------------------------------------------------------- versions
class CommitConflict(RuntimeError):
    """Another writer has changed what this write was made from; the other's version stands."""


@dataclass(frozen=True)
class Bucket:
    """Where a bucket's records are and, if no change set lies on top, what they add up to."""

    base: str | None = None
    deltas: tuple[tuple[int, str], ...] = ()  # (version that added it, write)
    keys: int | None = 0
    digests: tuple[int, int] | None = (0, 0)
    deadline: datetime | None = None  # the lowest of base and change sets


@dataclass(frozen=True)
class State:
    """A committed version of a group; number 0 stands for none."""

    group: str
    number: int = 0
    buckets: tuple[Bucket, ...] = ()

    @property
    def writes(self) -> set[str]:
        return {w for b in self.buckets for w in (b.base, *(w for _, w in b.deltas)) if w}


@dataclass(frozen=True)
class Commit:
    version: int
    written: int  #: records in the files of this write, as observed when they were written
    buckets: int  #: buckets it wrote


_VERSION_SCHEMA = ("bucket int, base string, deltas array<struct<version: long, write: string>>, keys long, h1 long, h2 long, "
                   "deadline timestamp_ntz")


def _group_path(root: str, kind: str, group: str) -> str:
    return f"{root.rstrip('/')}/{kind}/{GROUP}={group}"


def _listed(spark: SparkSession, path: str, name: str) -> dict[str, object]:
    """File status of the sub-folders ``<name>=<value>`` of a folder, by value."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = list(fs.listStatus(p)) if fs.exists(p) else []
    return {st.getPath().getName().partition("=")[2]: st for st in found if st.getPath().getName().startswith(f"{name}=")}


def _delete(spark: SparkSession, path) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path) if isinstance(path, str) else path
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _load(spark: SparkSession, root: str, group: str, number: int) -> State:
    path = f"{_group_path(root, 'versions', group)}/{VERSION}={number}"
    rows = sorted(spark.read.schema(_VERSION_SCHEMA).parquet(path).collect(), key=lambda r: r.bucket)
    return State(group, number, tuple(
        Bucket(r.base, tuple((d.version, d.write) for d in r.deltas), r.keys, None if r.keys is None else (r.h1, r.h2), r.deadline) for r in rows))


def state(spark: SparkSession, root: str, group: str) -> State:
    """The last committed version of a group. A write may be told to start from one (``start``)."""
    numbers = [int(n) for n in _listed(spark, _group_path(root, "versions", group), VERSION)]
    return _load(spark, root, group, max(numbers)) if numbers else State(group)


def _states(spark: SparkSession, root: str, group: str | None) -> list[State]:
    groups = [group] if group is not None else sorted(_listed(spark, f"{root.rstrip('/')}/versions", GROUP))
    return [s for s in (state(spark, root, g) for g in groups) if s.number]


def _publish(spark: SparkSession, root: str, s: State) -> bool:
    """Make ``s`` the next version; False if another writer has published that number."""
    jvm, base = spark.sparkContext._jvm, _group_path(root, "versions", s.group)
    tmp, final = f"{base}/_new-{uuid.uuid4().hex}", f"{base}/{VERSION}={s.number}"
    rows = [(k, b.base, list(b.deltas), b.keys, *(b.digests or (None, None)), b.deadline) for k, b in enumerate(s.buckets)]
    spark.createDataFrame(rows, _VERSION_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(tmp)
    src, dst = (jvm.org.apache.hadoop.fs.Path(x) for x in (tmp, final))
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(src).toUri(),
                                                                spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(src, dst, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))  # fails if dst exists
    except Py4JJavaError as e:
        _delete(spark, tmp)
        if s.number in {int(n) for n in _listed(spark, base, VERSION)}:
            return False
        raise e
    return True


def _commit(spark: SparkSession, root: str, start: State, write: str, change: Callable[[State], tuple[Bucket, ...]]) -> int:
    """Publish ``change`` of the start state, or of a later one that it can be made on (else it raises :class:`CommitConflict`)."""
    at = start
    while True:
        try:
            buckets = change(at)
        except CommitConflict:
            _delete(spark, f"{_group_path(root, 'data', start.group)}/{WRITE}={write}")
            raise
        if _publish(spark, root, State(at.group, at.number + 1, buckets)):
            return at.number + 1
        at = state(spark, root, start.group)


def _untouched(start: State, now: State, buckets: set[int]) -> None:
    if now.number != start.number and (len(now.buckets) != len(start.buckets) or any(now.buckets[b] != start.buckets[b] for b in buckets)):
        raise CommitConflict(f"group {start.group!r}: version {now.number} has changed what version {start.number} held")


def vacuum(spark: SparkSession, root: str, group: str, retain: float = RETAIN) -> None:
    """Delete versions replaced more than ``retain`` seconds ago, and files of that age that no kept version names."""
    before = (time.time() - retain) * 1000
    versions = {int(n): st for n, st in _listed(spark, _group_path(root, "versions", group), VERSION).items()}
    order = sorted(versions)
    # a version is in use until its successor was published
    old = [n for n, nxt in zip(order, order[1:]) if versions[nxt].getModificationTime() < before]
    used = set().union(*[_load(spark, root, group, n).writes for n in order if n not in old], set())
    for n in old:
        _delete(spark, versions[n].getPath())
    for name, st in _listed(spark, _group_path(root, "data", group), WRITE).items():
        if name not in used and st.getModificationTime() < before:  # a younger one may belong to a writer that has yet to commit
            _delete(spark, st.getPath())


# ------------------------------------------------------------------- writes
def bucket_number(key: str, buckets: int, spark: SparkSession) -> int:
    return spark.range(1).select(bucket_of(F.lit(key), buckets)).first()[0]


def _write_files(spark: SparkSession, root: str, c: Contract, out: DataFrame, buckets: int) -> tuple[str, int, dict[int, Bucket]]:
    """Write records into a new folder: (its id, records written, content of each bucket that got files)."""
    write = f"w{uuid.uuid4().hex}"
    data = f"{_group_path(root, 'data', c.feature_group)}/{WRITE}={write}"
    if GONE not in out.columns:
        out = out.withColumn(GONE, F.lit(False))
    seen = Observation(write)
    # REBALANCE: a bucket is one task's file, and AQE splits one that is too large. Rows are counted after it, in the
    # tasks that write them, so a task that is run again counts once. Without AQE (the stream's batches) every task would
    # write a file to every bucket, and without the adaptive size every file a filter of 1 MB.
    with adaptive(out.sparkSession):
        (_with_typed(out, c).withColumn(BUCKET, bucket_of(KEY, buckets)).hint("rebalance", BUCKET)
            .sortWithinPartitions(BUCKET, KEY).observe(seen, F.count(F.lit(1)).alias("n"))
            .write.mode("errorifexists").options(**_BLOOM).partitionBy(BUCKET).parquet(data))
        written = int(seen.get["n"] or 0)
        if not _listed(spark, data, BUCKET):
            return write, 0, {}
        back = (spark.read.schema(_data_schema()).option("basePath", data).parquet(data)
                .groupBy(BUCKET).agg(F.count(F.lit(1)).alias("keys"), *[F.bit_xor(h).alias(h) for h in DIGESTS],
                                     _utc(F.min(EXPIRES_AT)).alias("deadline")).collect())  # a row for each bucket
    if sum(r["keys"] for r in back) != written:
        raise RuntimeError(f"{written} records were written, but the files hold {sum(r['keys'] for r in back)}")
    return write, written, {r[BUCKET]: Bucket(write, (), r["keys"], (r["h1"], r["h2"]), r["deadline"]) for r in back}


def apply_changes(spark: SparkSession, root: str, c: Contract, live: DataFrame, deleted_keys: DataFrame, *,
                  buckets: int = DEFAULT_BUCKETS, start: State | None = None) -> Commit:
    """Upsert live records and delete keys of one feature group as a change set: its files hold these keys and no others.

    Re-running the same change set gives the same table. A key in both is kept live.
    """
    start = start or state(spark, root, c.feature_group)
    n = len(start.buckets) or buckets
    null = [F.lit(None).cast(t).alias(x) for x, t in zip(ONLINE_COLUMNS[1:], ("string", "map<string,string>", "string", "timestamp", "timestamp"))]
    dead = deleted_keys.select(KEY).distinct().join(live.select(KEY), KEY, "left_anti").select(KEY, *null, F.lit(True).alias(GONE))
    out = live.select(*ONLINE_COLUMNS, F.lit(False).alias(GONE)).unionByName(dead)
    write, written, found = _write_files(spark, root, c, out, n)
    if not found and start.number:
        return Commit(start.number, 0, 0)

    def change(now: State) -> tuple[Bucket, ...]:
        if len(now.buckets) not in (0, n):
            raise CommitConflict(f"group {now.group!r} has now {len(now.buckets)} buckets")
        old = now.buckets or (Bucket(),) * n
        return tuple(b if k not in found else replace(
            b, deltas=(*b.deltas, (now.number + 1, write)), keys=None, digests=None,
            deadline=min((d for d in (b.deadline, found[k].deadline) if d), default=None)) for k, b in enumerate(old))
    return Commit(_commit(spark, root, start, write, change), written, len(found))


def write_online(spark: SparkSession, recs: DataFrame, root: str, c: Contract, *, mode: str = "replace",
                 buckets: int | None = None, clock: datetime | str | None = None, start: State | None = None,
                 retain: float = RETAIN) -> Commit:
    """Write encoded records of one feature group into the online table.

    ``buckets`` sets the bucket count of a new or replaced group; a merge keeps the stored one. ``start`` is the
    version the write was made from, if that is not the last one.
    """
    if mode not in ("replace", "merge"):
        raise ValueError("mode must be 'replace' or 'merge'")
    start = start or state(spark, root, c.feature_group)
    if mode == "replace" or not start.number:
        n = buckets or len(start.buckets) or DEFAULT_BUCKETS
        write, written, found = _write_files(spark, root, c, recs, n)

        def change(now: State) -> tuple[Bucket, ...]:
            _untouched(start, now, set(range(len(now.buckets))) if len(now.buckets) == len(start.buckets) else {0})
            return tuple(found.get(k, Bucket()) for k in range(n))
        done = Commit(_commit(spark, root, start, write, change), written, len(found))
    else:
        n = len(start.buckets)
        touched = {r[0] for r in recs.select(bucket_of(KEY, n).alias(BUCKET)).distinct().collect()}
        done = _rewrite(spark, root, c, start, touched, lambda old: merge_records(old.filter(_alive(clock)), recs))
    vacuum(spark, root, c.feature_group, retain)
    return done


def _rewrite(spark: SparkSession, root: str, c: Contract, start: State, touched: set[int], made: Callable[[DataFrame], DataFrame],
             on_top: bool = False) -> Commit:
    """Replace the records of the touched buckets. ``on_top``: change sets that came in since stay on top of them."""
    if not touched:
        return Commit(start.number, 0, 0)
    old = _read_buckets(spark, root, [start], touched)
    write, written, found = _write_files(spark, root, c, made(old), len(start.buckets))

    def change(now: State) -> tuple[Bucket, ...]:
        out = list(now.buckets)
        if not on_top:
            _untouched(start, now, touched)
        for k in touched:
            new, had = found.get(k, Bucket()), start.buckets[k]
            if on_top and now.number != start.number:
                if len(now.buckets) != len(start.buckets) or now.buckets[k].base != had.base or now.buckets[k].deltas[:len(had.deltas)] != had.deltas:
                    raise CommitConflict(f"group {now.group!r}: bucket {k} was rewritten in version {now.number}")
                later = now.buckets[k].deltas[len(had.deltas):]
                if later:
                    new = replace(new, deltas=later, keys=None, digests=None, deadline=min((d for d in (new.deadline, now.buckets[k].deadline) if d), default=None))
            out[k] = new
        return tuple(out)
    return Commit(_commit(spark, root, start, write, change), written, len(found))


def compact(spark: SparkSession, root: str, c: Contract, *, min_deltas: int = 1, start: State | None = None, retain: float = RETAIN) -> Commit:
    """Fold change sets into the buckets that have at least ``min_deltas`` of them; ones added meanwhile stay on top."""
    start = start or state(spark, root, c.feature_group)
    due = {k for k, b in enumerate(start.buckets) if len(b.deltas) >= min_deltas}
    done = _rewrite(spark, root, c, start, due, lambda old: old, on_top=True)
    vacuum(spark, root, c.feature_group, retain)
    return done


def sweep(spark: SparkSession, root: str, c: Contract, *, clock: datetime | None = None, retain: float = RETAIN) -> Commit:
    """Remove expired records from the files. Only buckets whose lowest deadline has passed (by ``clock``, UTC) are opened."""
    start, now = state(spark, root, c.feature_group), clock or datetime.utcnow()
    due = {k for k, b in enumerate(start.buckets) if b.deadline is not None and b.deadline <= now}
    fixed = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.lit(now).cast("timestamp_ntz")).cast("timestamp")
    done = _rewrite(spark, root, c, start, due, lambda old: old.filter(F.col(EXPIRES_AT).isNull() | (F.col(EXPIRES_AT) > fixed)), on_top=True)
    vacuum(spark, root, c.feature_group, retain)
    return done


# -------------------------------------------------------------------- reads
def _files(spark: SparkSession, root: str, typed: Contract | None, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], _data_schema(typed))
    return spark.read.schema(_data_schema(typed)).option("basePath", f"{root.rstrip('/')}/data").parquet(*paths)


def _read_buckets(spark: SparkSession, root: str, states: list[State], only: set[int] | None = None,
                  typed: Contract | None = None, key: str | None = None) -> DataFrame:
    """Newest records of the named buckets; nothing else is listed or opened.

    Buckets without change sets are scanned as they are. In the others the newest of a key's changes wins, and hides the
    record below; only the changes are shuffled if they are small, not the buckets.
    """
    plain, covered, changes, rank = [], [], [], {}
    for s in states:
        for k, b in enumerate(s.buckets):
            if only is None or k in only:
                at = lambda w: f"{_group_path(root, 'data', s.group)}/{WRITE}={w}/{BUCKET}={k}"  # noqa: B023, E731
                if b.base:
                    (covered if b.deltas else plain).append(at(b.base))
                for version, w in b.deltas:
                    changes.append(at(w))
                    rank[w] = version
    pick = lambda paths: _files(spark, root, typed, paths).filter(F.lit(True) if key is None else F.col(KEY) == key)
    out = pick(plain)
    if changes:
        order = F.create_map(*[F.lit(x) for w, v in rank.items() for x in (w, v)])
        new = pick(changes)
        names = [x for x in new.columns if x not in (GROUP, KEY)]
        new = (new.groupBy(GROUP, KEY).agg(F.max_by(F.struct(*names), F.element_at(order, F.col(WRITE))).alias("r")).select(KEY, GROUP, "r.*"))
        base = pick(covered).join(new.select(GROUP, KEY), [GROUP, KEY], "left_anti")
        out = out.unionByName(base).unionByName(new.filter(~F.col(GONE)))
    return out.drop(GONE, WRITE, BUCKET, *DIGESTS)


def read_online(spark: SparkSession, root: str, group: str | None = None, *, clock: datetime | str | None = None,
                check_ttl: bool = True, key: str | None = None, typed: Contract | None = None,
                buckets: set[int] | None = None, at: State | None = None) -> DataFrame:
    """Online table rows, optionally one feature group, expired keys hidden.

    ``clock`` fixes "now" for the expiry test (default: current time). ``key`` restricts the read to that key
    in its bucket, ``buckets`` to some buckets. ``typed`` adds the typed columns of a contract's group. ``at`` reads a
    version that :func:`state` gave. A root without a committed version is an error.
    """
    states = [at] if at else _states(spark, root, group)
    if not states:
        raise FileNotFoundError(f"no committed online table under {root}" + (f" for group {group!r}" if group else ""))
    if key is not None:
        if group is None:
            raise ValueError("a point read needs the feature group")
        buckets = {bucket_number(key, len(states[0].buckets), spark)}
    df = _read_buckets(spark, root, states, buckets, typed, key)
    return df.filter(_alive(clock)) if check_ttl else df
