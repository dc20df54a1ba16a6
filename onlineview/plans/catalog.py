"""Registered queries: every snapshot/online operator run over the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` over whole tables; ``ORACLE``
holds the DuckDB SQL that must give the same rows. Queries that need a
written artefact (online table, exported snapshot, partitioned history) write
it under a fresh folder inside the session's shared checkpoint directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import encode as ENC
from ..operators import online as ON
from ..operators import reconcile as RC
from ..operators import snapshot as S
from ..session import scratch_path
from ..sinks import export as EX
from ..sinks import online_table as OT
from . import roles as R

# Fixed parameters of the registered queries (same literals in the oracles).
AS_OF = "2024-01-15 00:00:00"
CHANGES_AS_OF = "2024-01-30 00:00:00"
TTL_SECONDS = 6 * 3600
TTL_CLOCK = "2024-01-31 00:00:00"
SAMPLE = 25
POINT_KEY = "fs:events:7"
GEN_SALT = "42"
GEN_TOMBSTONE_SHARE = 0.03
GEN_TOMBSTONES = 40
CHANGE_SETS = 3
#: A user whose record is missing in the store, and one whose value is.
FAULTS = (7, 11)
LATE_HOURS = 6
STREAM_SLICES = 4
#: Factors that move ordinary values out of the range where the JVM's shortest text is exact.
DOUBLE_SCALES = [2.0 ** -44, 2.0 ** 60, 1e-300, 1.0, 1e17 / 3]
HOURLY_LATENESS_MINUTES = 15
HOURLY_SLICES = 3


# ----------------------------------------------------------------- snapshots
def latest_events(spark, sf):
    return S.latest(R.events(spark, sf), R.EVENTS).select(*R.EVENT_COLUMNS)


def latest_orders_tiebreak(spark, sf):
    return S.latest(R.orders(spark, sf), R.ORDERS).select(*R.ORDER_COLUMNS)


def latest_conversation_turn(spark, sf):
    return S.latest(R.conversations(spark, sf), R.CONVERSATIONS)


def latest_all_incl_tombstones(spark, sf):
    return S.latest(R.events(spark, sf), R.EVENTS, drop_tombstones=False).select(*R.EVENT_COLUMNS, "is_deleted")


def latest_by_max_by(spark, sf):
    return S.latest_by_max_by(R.events(spark, sf), R.EVENTS).select(*R.EVENT_COLUMNS)


def snapshot_counts(spark, sf):
    return S.snapshot_counts(R.events(spark, sf), R.EVENTS)


def orders_snapshot_counts(spark, sf):
    return S.snapshot_counts(R.orders(spark, sf), R.ORDERS)


def dedupe_bypass(spark, sf):
    return S.latest(R.events(spark, sf), R.EVENTS.with_(event_time_column="")).select(*R.EVENT_COLUMNS)


def metadata_projection(spark, sf):
    snap = S.latest(R.events(spark, sf), R.EVENTS)
    return ENC.project(snap, R.EVENTS, mode="all", keep_metadata=False)


SNAPSHOT_SQL = """
SELECT user_id, ts, value, event_type
FROM (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY user_id
    ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST
  ) AS rn
  FROM {table}
) AS ranked
WHERE rn = 1 AND NOT coalesce(is_deleted, false)
"""


def snapshot_sql(spark, sf):
    R.events(spark, sf).createOrReplaceTempView("events_history")
    return spark.sql(SNAPSHOT_SQL.format(table="events_history"))


def snapshot_as_of(spark, sf):
    return S.snapshot_as_of(R.events(spark, sf), R.EVENTS, AS_OF).select(*R.EVENT_COLUMNS)


def snapshot_changes(spark, sf):
    ev = R.events(spark, sf)
    old = S.snapshot_as_of(ev, R.EVENTS, CHANGES_AS_OF)
    new = S.latest(ev, R.EVENTS)
    return S.snapshot_changes(old, new, R.EVENTS)


def changes_since(spark, sf):
    return S.changes_since(R.events(spark, sf), R.EVENTS, CHANGES_AS_OF)


# ------------------------------------------------------------------ encoding
def hash_fields(spark, sf):
    return ENC.long_fields(S.latest(ENC.needed(R.events(spark, sf), R.EVENTS), R.EVENTS), R.EVENTS)


def orders_hash_fields(spark, sf):
    return ENC.long_fields(S.latest(ENC.needed(R.orders(spark, sf), R.ORDERS), R.ORDERS), R.ORDERS)


def json_docs(spark, sf):
    return ENC.json_docs(S.latest(R.events(spark, sf), R.EVENTS), R.EVENTS, mode="all")


def event_time_iso(spark, sf):
    from ..functions.text import iso_millis_z
    ev = R.table(spark, sf, "events")
    return ev.select("event_id", iso_millis_z("ts", ev.schema["ts"].dataType).alias("event_time"))


def double_text(spark, sf):
    """Values far outside the JVM's exact range: scaled by powers of two, and large primes."""
    from ..functions.text import py_float_text_exact
    ev = R.table(spark, sf, "events")
    scaled = F.array(*[(F.col("value") * F.lit(float(k))).alias(f"s{i}") for i, k in enumerate(DOUBLE_SCALES)])
    return (ev.select("event_id", F.posexplode(scaled).alias("scale", "v"))
            .select("event_id", "scale", py_float_text_exact("v").alias("text")))


def feature_named_hour(spark, sf):
    """A contract feature and a plain column that share names with partition columns stay in both modes."""
    ev = R.events(spark, sf).withColumn("hour", F.col("event_id") % 24).withColumn("day", F.col("event_id") % 31)
    c = R.EVENTS.with_(features=(*R.EVENTS.features, ("hour", "NUMERIC")))
    snap = S.drop_partition_columns(S.latest(ev, c), c)
    return ENC.long_fields(snap.drop("props"), c, mode="all").filter(F.col("field").isin("hour", "day"))


def _tied_orders(spark, sf):
    od = R.orders(spark, sf).withColumn("o_orderdate", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz"))
    return od.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", "is_deleted"), R.ORDERS.with_(write_time_column="")


def tie_winner_window(spark, sf):
    od, c = _tied_orders(spark, sf)
    return S.latest(od, c, drop_tombstones=False)


def tie_winner_max_by(spark, sf):
    od, c = _tied_orders(spark, sf)
    return S.latest_by_max_by(od, c, drop_tombstones=False).select(*od.columns)


def quarantine(spark, sf):
    """Every seventh event loses its entity id: set aside rows and the entities that remain."""
    ev = R.events(spark, sf).withColumn("user_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")))
    n = S.quarantined(ev, R.EVENTS).agg(F.count("*").alias("quarantined"))
    return n.crossJoin(S.snapshot_counts(ev, R.EVENTS))  # one row each


# -------------------------------------------------------------- online table
def _online(spark, sf, contracts=("events",), ttl_anchor="write", contract_over=None):
    root = scratch_path(spark, "online")
    for name in contracts:
        c = {"events": R.EVENTS, "orders": R.ORDERS, "conversations": R.CONVERSATIONS}[name]
        if contract_over and name in contract_over:
            c = contract_over[name]
        src = {"events": R.events, "orders": R.orders, "conversations": R.conversations}[name](spark, sf)
        recs = OT.records(S.latest(ENC.needed(src, c), c), c, ttl_anchor=ttl_anchor)
        OT.write_online(spark, recs, root, c)
    return root


def typed_view(spark, sf):
    root = _online(spark, sf)
    return ON.typed_view(OT.read_online(spark, root, "events", typed=R.EVENTS), R.EVENTS)


def tag_aggregate(spark, sf):
    root = _online(spark, sf)
    view = ON.typed_view(OT.read_online(spark, root, "events", typed=R.EVENTS), R.EVENTS)
    return ON.aggregate(view, "event_type",
                        {"avg_value": F.round(F.avg("value"), 4), "n": F.count("*")},
                        sort_by=[F.desc("avg_value")])


def derived_aggregate(spark, sf):
    root = _online(spark, sf)
    view = ON.typed_view(OT.read_online(spark, root, "events", typed=R.EVENTS), R.EVENTS)
    return ON.aggregate(view, "value_band",
                        {"avg_value": F.round(F.avg("value"), 4), "n": F.count("*")},
                        apply={"value_band": F.floor(F.col("value") / 100).cast("long")},
                        sort_by=[F.asc("value_band")])


def point_get(spark, sf):
    root = _online(spark, sf)
    return ENC.explode_fields(ON.get(OT.read_online(spark, root, "events", key=POINT_KEY), POINT_KEY))


def selected_fields(spark, sf):
    root = _online(spark, sf)
    return ON.select_fields(OT.read_online(spark, root, "events"), ["value", "event_type"])


def batch_get(spark, sf):
    root = _online(spark, sf, contracts=("orders",))
    store = OT.read_online(spark, root, "orders")
    got = ON.batch_get(store, R.table(spark, sf, "customer"), R.ORDERS, entity_column="c_custkey")
    return got.select("c_custkey", "key",
                      ENC.field_value("o_totalprice").try_cast("double").alias("o_totalprice"),
                      ENC.field_value("o_orderpriority").alias("o_orderpriority"))


def key_count(spark, sf):
    root = _online(spark, sf, contracts=("events", "orders"))
    return ON.key_count(OT.read_online(spark, root))


def _fields_stored(spark, root):
    return ENC.explode_fields(OT.read_online(spark, root, "events", check_ttl=False))


def replace_to_empty(spark, sf):
    """A snapshot in which every entity is tombstoned replaces a full one: nothing stays online."""
    root = _online(spark, sf)
    gone = S.latest(R.events(spark, sf).withColumn("is_deleted", F.lit(True)), R.EVENTS)
    OT.write_online(spark, OT.records(gone, R.EVENTS), root, R.EVENTS)
    return OT.read_online(spark, root, "events").select("key")


def merge_overlay(spark, sf):
    """The newest snapshot, without its value for even users, merged over an older one."""
    ev = R.events(spark, sf)
    root = scratch_path(spark, "online")
    OT.write_online(spark, OT.records(S.snapshot_as_of(ev, R.EVENTS, CHANGES_AS_OF), R.EVENTS), root, R.EVENTS)
    new = S.latest(ev, R.EVENTS).withColumn("value", F.when(F.col("user_id") % 2 == 1, F.col("value")))
    OT.write_online(spark, OT.records(new, R.EVENTS), root, R.EVENTS, mode="merge")
    return _fields_stored(spark, root)


def delete_last_key(spark, sf):
    """All keys deleted in two change sets, the second of which takes the last ones."""
    root = _online(spark, sf)
    keys = OT.read_online(spark, root, "events").select("key", F.pmod(F.xxhash64("key"), F.lit(2)).alias("half"))
    keys = keys.persist()
    none = OT.read_online(spark, root, "events").limit(0)
    for half in (0, 1):
        OT.apply_changes(spark, root, R.EVENTS, none, keys.filter(F.col("half") == half).select("key"))
    keys.unpersist()
    return ON.key_count(OT.read_online(spark, root, "events"))


def ttl_merge(spark, sf):
    """Old records that have expired by the clock are absent in a merge; a fresh one without deadline shows."""
    ev = R.events(spark, sf)
    root = scratch_path(spark, "online")
    c = R.EVENTS.with_(ttl_seconds=TTL_SECONDS)
    old = S.snapshot_as_of(ev, c, CHANGES_AS_OF)
    OT.write_online(spark, OT.records(old, c, ttl_anchor="event"), root, c)
    new = S.latest(ev, R.EVENTS).filter(F.col("user_id") % 3 == 0).withColumn("value", F.lit(None).cast("double"))
    OT.write_online(spark, OT.records(new, R.EVENTS), root, R.EVENTS, mode="merge", clock=TTL_CLOCK)
    return ENC.explode_fields(OT.read_online(spark, root, "events", clock=TTL_CLOCK))


def _halves(df, n):
    """The records whose bucket is even, and the others."""
    odd = OT.bucket_of("key", n) % 2
    return df.filter(odd == 0), df.filter(odd == 1)


def _old_and_new(spark, sf):
    ev = R.events(spark, sf)
    root = scratch_path(spark, "online")
    OT.write_online(spark, OT.records(S.snapshot_as_of(ev, R.EVENTS, CHANGES_AS_OF), R.EVENTS), root, R.EVENTS)
    return root, ev


def concurrent_merge(spark, sf):
    """Three writers start from one version: two merge into disjoint buckets, the third comes too late for its bucket."""
    root, ev = _old_and_new(spark, sf)
    start = OT.state(spark, root, "events")
    new = OT.records(S.latest(ev, R.EVENTS), R.EVENTS)
    for part in _halves(new, len(start.buckets)):
        OT.write_online(spark, part, root, R.EVENTS, mode="merge", start=start)
    spoiled = new.withColumn("fields", F.transform_values("fields", lambda k, v: F.lit("lost")))
    try:
        OT.write_online(spark, spoiled, root, R.EVENTS, mode="merge", start=start)
    except OT.CommitConflict:
        pass
    return _fields_stored(spark, root)


def _change_sets(spark, sf):
    """The old snapshot with the newest one on top, in three change sets of live records and deleted keys."""
    root, ev = _old_and_new(spark, sf)
    last = S.latest(ev, R.EVENTS, drop_tombstones=False).withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(CHANGE_SETS)))
    last = last.persist()
    for k in range(CHANGE_SETS):
        some = last.filter(F.col("part") == k)
        OT.apply_changes(spark, root, R.EVENTS, OT.records(some.filter("NOT is_deleted"), R.EVENTS),
                         some.filter("is_deleted").select(ENC.online_key(R.EVENTS).alias("key")))
    last.unpersist()
    return root


def change_sets_on_read(spark, sf):
    root = _change_sets(spark, sf)
    return ON.typed_view(OT.read_online(spark, root, "events", typed=R.EVENTS), R.EVENTS)


def change_sets_folded(spark, sf):
    root = _change_sets(spark, sf)
    OT.compact(spark, root, R.EVENTS)
    at = OT.state(spark, root, "events")
    assert not any(b.deltas for b in at.buckets)
    return ON.typed_view(OT.read_online(spark, root, "events", typed=R.EVENTS, at=at), R.EVENTS)


def expiry_sweep(spark, sf):
    """Keys left in the files, expired or not, after a sweep by a fixed clock."""
    from datetime import datetime
    c = R.EVENTS.with_(ttl_seconds=TTL_SECONDS)
    root = _online(spark, sf, ttl_anchor="event", contract_over={"events": c})
    OT.sweep(spark, root, c, clock=datetime.fromisoformat(TTL_CLOCK))
    return OT.read_online(spark, root, "events", check_ttl=False).select("key")


def observed_writes(spark, sf):
    """Records that a replacement and two change sets wrote, as observed in the writing tasks."""
    ev = R.events(spark, sf)
    root = scratch_path(spark, "online")
    live = OT.records(S.latest(ev, R.EVENTS), R.EVENTS)
    done = [("replace", OT.write_online(spark, live, root, R.EVENTS))]
    none = live.select("key").limit(0)
    done += [(f"changes {k}", OT.apply_changes(spark, root, R.EVENTS, part, none)) for k, part in enumerate(_halves(live, 16))]
    rows = [(name, d.written) for name, d in done]
    total = OT.read_online(spark, root, "events").agg(F.lit("stored").alias("step"), F.count("*").alias("records"))
    return total.unionByName(spark.createDataFrame([("replace", rows[0][1]), ("changes", rows[1][1] + rows[2][1])], "step string, records long"))


def digest_reconcile(spark, sf):
    """Planted faults, found by opening only the buckets whose digests differ."""
    snap = S.latest(R.events(spark, sf), R.EVENTS)
    expected = ENC.hash_fields(snap, R.EVENTS)
    root = scratch_path(spark, "online")
    faulty = snap.filter(F.col("user_id") != FAULTS[0]).withColumn("value", F.when(F.col("user_id") != FAULTS[1], F.col("value")))
    more = snap.orderBy("user_id").limit(1).withColumn("user_id", F.lit(-1).cast(snap.schema["user_id"].dataType))
    OT.write_online(spark, OT.records(faulty.unionByName(more), R.EVENTS), root, R.EVENTS, buckets=64)
    d, _ = RC.digest_diff(spark, expected, root, "events")
    return d.filter("status <> 'same'").select("key", "status", F.array_join("mismatched_fields", ",").alias("mismatched"))


def prefix_key_count(spark, sf):
    root = _online(spark, sf, contracts=("events", "orders", "conversations"))
    return ON.keys_per_group(OT.read_online(spark, root))


def ttl_live_keys(spark, sf):
    c = R.EVENTS.with_(ttl_seconds=TTL_SECONDS)
    root = _online(spark, sf, ttl_anchor="event", contract_over={"events": c})
    return OT.read_online(spark, root, "events", clock=TTL_CLOCK).select("key")


def readback_sample(spark, sf):
    recs = ENC.hash_fields(S.latest(R.events(spark, sf), R.EVENTS), R.EVENTS)
    return RC.sample_keys(recs, SAMPLE)


# --------------------------------------------------------------- reconcile
def _expected_and_stale_store(spark, sf):
    ev = R.events(spark, sf)
    expected = ENC.hash_fields(S.latest(ev, R.EVENTS), R.EVENTS)
    root = scratch_path(spark, "online")
    old = OT.records(S.snapshot_as_of(ev, R.EVENTS, CHANGES_AS_OF), R.EVENTS)
    OT.write_online(spark, old, root, R.EVENTS)
    return expected, OT.read_online(spark, root, "events")


def reconcile_report(spark, sf):
    expected, stored = _expected_and_stale_store(spark, sf)
    d = RC.diff(expected, stored)
    return d.select("key", "status", "n_mismatched",
                    F.array_join("mismatched_fields", ",").alias("mismatched"))


def reconcile_summary(spark, sf):
    expected, stored = _expected_and_stale_store(spark, sf)
    return RC.summary(RC.diff(expected, stored))


def sampled_diff(spark, sf):
    expected, stored = _expected_and_stale_store(spark, sf)
    return RC.sampled_diff(expected, stored, SAMPLE).select("key", "status", "n_mismatched")


def stale_keys(spark, sf):
    expected, stored = _expected_and_stale_store(spark, sf)
    return RC.stale_keys(expected, stored)


def count_check(spark, sf):
    expected, stored = _expected_and_stale_store(spark, sf)
    return RC.count_check(expected, stored)


# ------------------------------------------------------------ sinks / layout
def snapshot_roundtrip(spark, sf):
    path = scratch_path(spark, "snapshot")
    EX.export_snapshot(S.latest(R.events(spark, sf), R.EVENTS).select(*R.EVENT_COLUMNS), path)
    return EX.read_snapshot(spark, path).select(*R.EVENT_COLUMNS)


def history_partition_scan(spark, sf):
    path = scratch_path(spark, "history")
    EX.append_history(R.table(spark, sf, "events"), path, "ts")
    hist = R.read_history(spark, path)
    return hist.groupBy("year", "month", "day", "hour").agg(F.count("*").alias("records"))


def hourly_arrivals(spark, sf):
    ev = R.table(spark, sf, "events")
    w = F.window(F.col("ts").cast("timestamp"), "1 hour")
    return (ev.groupBy(w.alias("w")).agg(F.count("*").alias("arrivals"))
              .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "arrivals"))


def hourly_arrivals_streamed(spark, sf):
    """The watermarked stream, fed slice by slice with rows up to ten minutes late: hours that have closed."""
    from ..streaming import refresh as RF
    src, out, ckpt = (scratch_path(spark, n) for n in ("stream-src", "arrivals", "stream-ckpt"))
    ev = R.table(spark, sf, "events").select("event_id", "ts")
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod("event_id", F.lit(11)) * 60_000_000
    lo, hi = ev.agg(F.min(arrival), F.max(arrival)).first()
    nth = F.floor((arrival - (lo or 0)) * HOURLY_SLICES / ((hi or 0) - (lo or 0) + 1))
    for i in range(HOURLY_SLICES):  # each run takes up the new files from the checkpoint, state and watermark included
        ev.filter(nth == i).write.mode("append").parquet(src)
        (RF.hourly_arrivals(RF.history_stream(spark, src, ev.schema), "ts", lateness=f"{HOURLY_LATENESS_MINUTES} minutes")
           .writeStream.outputMode("append").format("parquet").option("path", out)
           .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination())
    got = spark.read.schema("window_start timestamp, arrivals long").parquet(out)
    return got.select(F.col("window_start").cast("timestamp_ntz"), "arrivals")


def late_arrivals(spark, sf):
    """Hours with their records on time and late. A thirteenth of the records arrives six hours after its time."""
    from ..streaming import refresh as RF
    src, out, ckpt = (scratch_path(spark, n) for n in ("stream-src", "arrivals", "stream-ckpt"))
    ev = R.table(spark, sf, "events").select("event_id", "ts")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    arrival = us + F.when(F.col("event_id") % 13 == 0, LATE_HOURS * 3_600_000_000).otherwise(0)
    lo, hi = ev.agg(F.min(arrival), F.max(arrival)).first()
    nth = F.call_function("div", (arrival - (lo or 0)) * HOURLY_SLICES, F.lit((hi or 0) - (lo or 0) + 1).cast("long"))
    for i in range(HOURLY_SLICES):  # a slice is a batch
        ev.filter(nth == i).coalesce(1).write.mode("append").parquet(src)
        (RF.history_stream(spark, src, ev.schema).writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
           .foreachBatch(RF.split_arrivals("ts", out, lateness=f"{HOURLY_LATENESS_MINUTES} minutes")).start().awaitTermination())
    hour = F.window(F.col("ts").cast("timestamp"), "1 hour")["start"]
    late = spark.read.schema(ev.schema).parquet(f"{out}/late").groupBy(hour.alias("window_start")).agg(F.count("*").alias("late"))
    both = RF.arrivals(spark, out).join(late, "window_start", "full_outer")
    return both.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.coalesce("arrivals", F.lit(0)).alias("on_time"),
                       F.coalesce("late", F.lit(0)).alias("late"))


def history_merge_schema(spark, sf):
    path = scratch_path(spark, "history-parts")
    ev = R.table(spark, sf, "events")
    full = ev.filter(F.col("event_type").isin("click", "view"))
    slim = ev.filter(~F.col("event_type").isin("click", "view") | F.col("event_type").isNull()).drop("props")
    full.write.parquet(f"{path}/part=a")
    slim.write.parquet(f"{path}/part=b")
    hist = R.read_history(spark, [f"{path}/part=a", f"{path}/part=b"], merge_schema=True)
    hist = R.flag_column(hist, "is_deleted", "event_type = 'error'")
    return S.latest(hist, R.EVENTS).select(*R.EVENT_COLUMNS)


def _generated(spark, sf):
    from ..operators import datagen as G
    return G.generate_history(R.table(spark, sf, "customer"), "c_custkey", tombstone_share=GEN_TOMBSTONE_SHARE,
                              salt=GEN_SALT)


def generated_history_invariants(spark, sf):
    from ..operators import datagen as G
    path = scratch_path(spark, "generated-history")
    EX.append_history(_generated(spark, sf), path, "event_time", writers=2)
    return S.snapshot_counts(R.read_history(spark, path), G.GENERATED_CONTRACT)


def generated_tombstones(spark, sf):
    """The entities of a history with an exact number of tombstones that have one."""
    from ..operators import datagen as G
    h = G.generate_history(R.table(spark, sf, "customer"), "c_custkey", tombstones=GEN_TOMBSTONES, salt=GEN_SALT)
    return h.filter("is_deleted").select("customer_id")


def generated_values(spark, sf):
    h = _generated(spark, sf)
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias(c)
    return h.select("customer_id", "event_time", "fraud_score", "credit_score", "avg_ticket_30d", "tx_count_24h",
                    "device_trust", "segment", "is_pep", iso("api_invocation_time"), iso("write_time"), "is_deleted")


def incremental_latest(spark, sf):
    """The refresh stream over several micro-batches; every slice spans all times, so most rows come late."""
    from ..streaming import refresh as RF
    src = scratch_path(spark, "stream-src")
    ev = R.table(spark, sf, "events")
    for k in range(STREAM_SLICES):  # one arrival after another; files grow with the data
        ev.filter(F.pmod(F.xxhash64("event_id"), F.lit(STREAM_SLICES)) == k).write.parquet(f"{src}/slice={k}")
    files = len(spark.read.parquet(src).inputFiles())
    root, ck = scratch_path(spark, "online"), scratch_path(spark, "stream-ckpt")
    q = RF.refresh(spark, f"{src}/*", ev.schema, R.EVENTS, root, ck, max_files_per_trigger=-(-files // STREAM_SLICES),
                   adapter=lambda d: R.flag_column(d, "is_deleted", "event_type = 'error'"))
    q.awaitTermination()
    return ON.typed_view(OT.read_online(spark, root, "events", typed=R.EVENTS), R.EVENTS)


def _bootstrapped(spark, sf):
    """Three quarters of the events as history, handed over; then the last quarter arrives. Table root and rows read."""
    from ..streaming import bootstrap as BS
    src, root, path, ck = (scratch_path(spark, n) for n in ("stream-src", "online", "hand-over", "stream-ckpt"))
    ev = R.table(spark, sf, "events")
    arrival = F.pmod("event_id", F.lit(STREAM_SLICES))
    ev.filter(arrival != STREAM_SLICES - 1).write.parquet(f"{src}/arrival=0")
    with_flag = lambda d: R.flag_column(d, "is_deleted", "event_type = 'error'")
    h = BS.bootstrap(spark, f"{src}/*", ev.schema, R.EVENTS, root, path, adapter=with_flag, overlap=0)
    ev.filter(arrival == STREAM_SLICES - 1).write.parquet(f"{src}/arrival=1")
    BS.adopt(spark, f"{src}/*", ev.schema, h, adapter=with_flag)
    q = BS.refresh_from(spark, f"{src}/*", ev.schema, R.EVENTS, root, ck, h, adapter=with_flag)
    q.awaitTermination()
    return root, sum(p["numInputRows"] for p in q.recentProgress)


def bootstrap_latest(spark, sf):
    """The refresh stream started from a batch snapshot of the earlier history."""
    root, _ = _bootstrapped(spark, sf)
    return ON.typed_view(OT.read_online(spark, root, "events", typed=R.EVENTS), R.EVENTS)


def bootstrap_input(spark, sf):
    """Rows that the stream has read after the hand-over: one for each entity of the snapshot, and the new events."""
    _, read = _bootstrapped(spark, sf)
    return spark.range(1).select(F.lit(read).cast("long").alias("rows_read"))


QUERIES = {
    "latest_events": latest_events,
    "latest_orders_tiebreak": latest_orders_tiebreak,
    "latest_conversation_turn": latest_conversation_turn,
    "latest_all_incl_tombstones": latest_all_incl_tombstones,
    "latest_by_max_by": latest_by_max_by,
    "snapshot_counts": snapshot_counts,
    "orders_snapshot_counts": orders_snapshot_counts,
    "dedupe_bypass": dedupe_bypass,
    "metadata_projection": metadata_projection,
    "snapshot_sql": snapshot_sql,
    "snapshot_as_of": snapshot_as_of,
    "snapshot_changes": snapshot_changes,
    "changes_since": changes_since,
    "hash_fields": hash_fields,
    "orders_hash_fields": orders_hash_fields,
    "json_docs": json_docs,
    "event_time_iso": event_time_iso,
    "typed_view": typed_view,
    "tag_aggregate": tag_aggregate,
    "derived_aggregate": derived_aggregate,
    "point_get": point_get,
    "selected_fields": selected_fields,
    "batch_get": batch_get,
    "prefix_key_count": prefix_key_count,
    "ttl_live_keys": ttl_live_keys,
    "readback_sample": readback_sample,
    "reconcile_report": reconcile_report,
    "reconcile_summary": reconcile_summary,
    "stale_keys": stale_keys,
    "count_check": count_check,
    "snapshot_roundtrip": snapshot_roundtrip,
    "history_partition_scan": history_partition_scan,
    "hourly_arrivals": hourly_arrivals,
    "hourly_arrivals_streamed": hourly_arrivals_streamed,
    "history_merge_schema": history_merge_schema,
    "generated_history_invariants": generated_history_invariants,
    "incremental_latest": incremental_latest,
    "double_text": double_text,
    "feature_named_hour": feature_named_hour,
    "tie_winner_window": tie_winner_window,
    "tie_winner_max_by": tie_winner_max_by,
    "quarantine": quarantine,
    "key_count": key_count,
    "replace_to_empty": replace_to_empty,
    "merge_overlay": merge_overlay,
    "delete_last_key": delete_last_key,
    "ttl_merge": ttl_merge,
    "sampled_diff": sampled_diff,
    "generated_values": generated_values,
    "generated_tombstones": generated_tombstones,
    "concurrent_merge": concurrent_merge,
    "change_sets_on_read": change_sets_on_read,
    "change_sets_folded": change_sets_folded,
    "expiry_sweep": expiry_sweep,
    "observed_writes": observed_writes,
    "digest_reconcile": digest_reconcile,
    "late_arrivals": late_arrivals,
    "bootstrap_latest": bootstrap_latest,
    "bootstrap_input": bootstrap_input,
}


# =================================================================== oracles
def _latest_sql(table: str, entity: str, order: str, cols: str, live: str | None) -> str:
    where = "rn = 1" + (f" AND NOT coalesce({live}, false)" if live else "")
    return (f"SELECT {cols} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {entity} ORDER BY {order}) AS rn "
            f"FROM {table} WHERE {entity} IS NOT NULL) AS ranked WHERE {where}")


EV_ORDER = "ts DESC NULLS LAST, event_id DESC NULLS LAST, value DESC NULLS LAST, event_type DESC NULLS LAST"
EV_COLS = "event_id, ts, user_id, event_type, value, props"
EV_LIVE = "event_type = 'error'"
OR_ORDER = ("o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST, o_totalprice DESC NULLS LAST, "
            "o_orderpriority DESC NULLS LAST")
OR_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

EV_LATEST = _latest_sql("events", "user_id", EV_ORDER, EV_COLS, EV_LIVE)
EV_LATEST_ALL = _latest_sql("events", "user_id", EV_ORDER, EV_COLS + ", event_type = 'error' AS is_deleted", None)
EV_AS_OF = _latest_sql(f"(SELECT * FROM events WHERE ts < TIMESTAMP '{AS_OF}')", "user_id", EV_ORDER, EV_COLS,
                       EV_LIVE)
EV_CHANGES_OLD = _latest_sql(f"(SELECT * FROM events WHERE ts < TIMESTAMP '{CHANGES_AS_OF}')", "user_id",
                             EV_ORDER, EV_COLS, EV_LIVE)
OR_LATEST = _latest_sql("orders", "o_custkey", OR_ORDER, OR_COLS, "o_orderstatus = 'F'")
CV_LATEST = _latest_sql("conversations", "conv_id", "turn DESC NULLS LAST, role DESC NULLS LAST, text DESC NULLS LAST",
                        "conv_id, turn, role, text", None)


def _counts_sql(table, entity, order, live):
    ranked = _latest_sql(table, entity, order, f"{entity}, coalesce({live}, false) AS d", None)
    return (f"SELECT (SELECT count(*) FROM {table}) AS raw_records, count(*) AS entities, "
            f"count(*) FILTER (WHERE d) AS tombstoned, count(*) FILTER (WHERE NOT d) AS live FROM ({ranked}) AS s")


def _iso(col: str) -> str:
    return (f"CASE WHEN strftime({col}, '%f') = '000000' THEN strftime({col}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({col}, '%Y-%m-%dT%H:%M:%S') || '.' || strftime({col}, '%f') END")


def _long_sql(snapshot_sql: str, prefix: str, entity: str, fields: list[tuple[str, str]]) -> str:
    parts = [f"SELECT '{prefix}:' || CAST({entity} AS VARCHAR) AS key, '{name}' AS field, {expr} AS value "
             f"FROM ({snapshot_sql}) AS s WHERE {expr} IS NOT NULL" for name, expr in fields]
    return " UNION ALL ".join(parts)


EV_FIELDS = [("user_id", "CAST(user_id AS VARCHAR)"), ("ts", _iso("ts")),
             ("value", "CAST(value AS VARCHAR)"), ("event_type", "event_type")]
EV_LONG = _long_sql(EV_LATEST, "fs:events", "user_id", EV_FIELDS)
EV_LONG_OLD = _long_sql(EV_CHANGES_OLD, "fs:events", "user_id", EV_FIELDS)
OR_LONG = _long_sql(OR_LATEST, "fs:orders", "o_custkey", [
    ("o_custkey", "CAST(o_custkey AS VARCHAR)"), ("o_orderdate", _iso("o_orderdate")),
    ("o_totalprice", "CAST(o_totalprice AS VARCHAR)"), ("o_orderpriority", "o_orderpriority")])

_DIFF_SQL = f"""
WITH el AS ({EV_LONG}), sl AS ({EV_LONG_OLD}),
fj AS (SELECT coalesce(el.key, sl.key) AS key, coalesce(el.field, sl.field) AS field,
              el.value AS ev, sl.value AS sv
       FROM el FULL OUTER JOIN sl ON el.key = sl.key AND el.field = sl.field),
ek AS (SELECT DISTINCT key FROM el), sk AS (SELECT DISTINCT key FROM sl),
ks AS (SELECT coalesce(ek.key, sk.key) AS key, ek.key IS NOT NULL AS in_e, sk.key IS NOT NULL AS in_s
       FROM ek FULL OUTER JOIN sk ON ek.key = sk.key),
mm AS (SELECT key, count(*) FILTER (WHERE ev IS DISTINCT FROM sv) AS n,
              string_agg(field, ',' ORDER BY field) FILTER (WHERE ev IS DISTINCT FROM sv) AS f
       FROM fj GROUP BY key),
d AS (SELECT ks.key,
             CASE WHEN NOT in_s THEN 'missing' WHEN NOT in_e THEN 'extra'
                  WHEN mm.n > 0 THEN 'changed' ELSE 'same' END AS status,
             CASE WHEN in_e AND in_s THEN mm.n ELSE 0 END AS n_mismatched,
             CASE WHEN in_e AND in_s THEN coalesce(mm.f, '') ELSE '' END AS mismatched
      FROM ks LEFT JOIN mm ON ks.key = mm.key)
"""

ORACLE_TYPED_VIEW = f"""SELECT 'fs:events:' || CAST(user_id AS VARCHAR) AS key, CAST(user_id AS VARCHAR) AS user_id,
                       value, event_type FROM ({EV_LATEST}) AS s"""

_GEN_SQL = f"""
WITH e AS (SELECT format('C{{:06d}}', c_custkey) AS cid FROM customer),
f AS (SELECT cid,
             CAST('0x' || substr(md5('{GEN_SALT}' || 'v' || cid), 1, 8) AS BIGINT) % 3 + 1 AS n,
             CAST('0x' || substr(md5('{GEN_SALT}' || 'd' || cid), 1, 8) AS BIGINT) / 4294967296.0
                 < {GEN_TOMBSTONE_SHARE} AS tomb
      FROM e)
SELECT CAST(sum(n) + count(*) FILTER (WHERE tomb) AS BIGINT) AS raw_records, count(*) AS entities,
       count(*) FILTER (WHERE tomb) AS tombstoned, count(*) FILTER (WHERE NOT tomb) AS live
FROM f"""

ORACLE = {
    "latest_events": EV_LATEST,
    "latest_orders_tiebreak": OR_LATEST,
    "latest_conversation_turn": CV_LATEST,
    "latest_all_incl_tombstones": EV_LATEST_ALL,
    "latest_by_max_by": EV_LATEST,
    "snapshot_counts": _counts_sql("events", "user_id", EV_ORDER, EV_LIVE),
    "orders_snapshot_counts": _counts_sql("orders", "o_custkey", OR_ORDER, "o_orderstatus = 'F'"),
    "dedupe_bypass": f"SELECT {EV_COLS} FROM events",
    "metadata_projection": _latest_sql("events", "user_id", EV_ORDER, "ts, user_id, event_type, value, props",
                                       EV_LIVE),
    "snapshot_sql": SNAPSHOT_SQL.format(
        table="(SELECT *, event_type = 'error' AS is_deleted FROM events)"),
    "snapshot_as_of": EV_AS_OF,
    "snapshot_changes": f"""
        SELECT coalesce(n.user_id, o.user_id) AS user_id,
               CASE WHEN o.user_id IS NULL THEN 'added' WHEN n.user_id IS NULL THEN 'removed'
                    WHEN o.ts IS NOT DISTINCT FROM n.ts AND o.value IS NOT DISTINCT FROM n.value
                         AND o.event_type IS NOT DISTINCT FROM n.event_type THEN 'same'
                    ELSE 'changed' END AS change
        FROM ({EV_CHANGES_OLD}) AS o FULL OUTER JOIN ({EV_LATEST}) AS n ON o.user_id = n.user_id""",
    "hash_fields": EV_LONG,
    "orders_hash_fields": OR_LONG,
    "json_docs": f"""
        SELECT 'fs:events:' || CAST(user_id AS VARCHAR) AS key,
               CAST(to_json(struct_pack(ts := {_iso('ts')}, user_id := user_id, event_type := event_type,
                                        value := value, props := props)) AS VARCHAR) AS doc
        FROM ({EV_LATEST}) AS s""",
    "event_time_iso": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_time FROM events",
    "typed_view": ORACLE_TYPED_VIEW,
    "tag_aggregate": f"""SELECT event_type, round(avg(value), 4) AS avg_value, count(*) AS n
                         FROM ({EV_LATEST}) AS s GROUP BY event_type ORDER BY avg_value DESC""",
    "derived_aggregate": f"""SELECT CAST(floor(value / 100) AS BIGINT) AS value_band,
                                    round(avg(value), 4) AS avg_value, count(*) AS n
                             FROM ({EV_LATEST}) AS s GROUP BY 1 ORDER BY 1""",
    "point_get": f"SELECT key, field, value FROM ({EV_LONG}) AS l WHERE key = '{POINT_KEY}'",
    "selected_fields": f"""SELECT 'fs:events:' || CAST(user_id AS VARCHAR) AS key,
                                  CAST(value AS VARCHAR) AS value, event_type FROM ({EV_LATEST}) AS s""",
    "batch_get": f"""SELECT c.c_custkey, 'fs:orders:' || CAST(c.c_custkey AS VARCHAR) AS key,
                            s.o_totalprice, s.o_orderpriority
                     FROM customer AS c LEFT JOIN ({OR_LATEST}) AS s ON s.o_custkey = c.c_custkey""",
    "prefix_key_count": f"""SELECT 'events' AS feature_group, count(*) AS keys FROM ({EV_LATEST}) AS a
                            UNION ALL SELECT 'orders', count(*) FROM ({OR_LATEST}) AS b
                            UNION ALL SELECT 'conversations', count(*) FROM ({CV_LATEST}) AS c""",
    "ttl_live_keys": f"""SELECT 'fs:events:' || CAST(user_id AS VARCHAR) AS key FROM ({EV_LATEST}) AS s
                         WHERE ts + INTERVAL {TTL_SECONDS} SECOND > TIMESTAMP '{TTL_CLOCK}'""",
    "readback_sample": f"""SELECT key FROM (SELECT 'fs:events:' || CAST(user_id AS VARCHAR) AS key
                           FROM ({EV_LATEST}) AS s) AS k ORDER BY md5(key), key LIMIT {SAMPLE}""",
    "reconcile_report": _DIFF_SQL + "SELECT key, status, n_mismatched, mismatched FROM d",
    "reconcile_summary": _DIFF_SQL + "SELECT status, count(*) AS keys, CAST(sum(n_mismatched) AS BIGINT) AS fields "
                                     "FROM d GROUP BY status",
    "stale_keys": _DIFF_SQL + "SELECT key FROM d WHERE status = 'extra'",
    "count_check": f"""SELECT e.n AS expected, s.n AS stored, e.n = s.n AS ok
                       FROM (SELECT count(*) AS n FROM ({EV_LATEST}) AS a) AS e,
                            (SELECT count(*) AS n FROM ({EV_CHANGES_OLD}) AS b) AS s""",
    "snapshot_roundtrip": EV_LATEST,
    "history_partition_scan": """SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
                                        CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
                                        count(*) AS records FROM events GROUP BY 1, 2, 3, 4""",
    "hourly_arrivals": "SELECT date_trunc('hour', ts) AS window_start, count(*) AS arrivals FROM events GROUP BY 1",
    "hourly_arrivals_streamed": f"""SELECT date_trunc('hour', ts) AS window_start, count(*) AS arrivals FROM events GROUP BY 1
        HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR
               <= (SELECT max(ts) FROM events) - INTERVAL {HOURLY_LATENESS_MINUTES} MINUTE""",
    "history_merge_schema": _latest_sql(
        "(SELECT event_id, ts, user_id, event_type, value, "
        "CASE WHEN event_type IN ('click', 'view') THEN props END AS props FROM events)",
        "user_id", EV_ORDER, EV_COLS, EV_LIVE),
    "generated_history_invariants": _GEN_SQL,
    "incremental_latest": ORACLE_TYPED_VIEW,
}
ORACLE["changes_since"] = ORACLE["snapshot_changes"]
ORACLE["bootstrap_latest"] = ORACLE_TYPED_VIEW
ORACLE["bootstrap_input"] = f"""
SELECT count(DISTINCT CASE WHEN event_id % {STREAM_SLICES} <> {STREAM_SLICES - 1} THEN user_id END)
     + count_if(event_id % {STREAM_SLICES} = {STREAM_SLICES - 1}) AS rows_read FROM events"""

_TIED = """(SELECT o_orderkey, o_custkey, date_trunc('month', o_orderdate) AS o_orderdate, o_totalprice,
                   o_orderpriority, o_orderstatus = 'F' AS is_deleted FROM orders) AS t"""
_TIE_ORDER = ("o_orderdate DESC NULLS LAST, coalesce(is_deleted, false) DESC, o_totalprice DESC NULLS LAST, "
              "o_orderpriority DESC NULLS LAST, o_orderkey DESC NULLS LAST")
ORACLE["tie_winner_window"] = ORACLE["tie_winner_max_by"] = _latest_sql(
    _TIED, "o_custkey", _TIE_ORDER, "o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderpriority, is_deleted", None)

ORACLE["double_text"] = " UNION ALL ".join(
    f"SELECT event_id, {i} AS scale, CAST(value * CAST({k!r} AS DOUBLE) AS VARCHAR) AS text FROM events"
    for i, k in enumerate(DOUBLE_SCALES))

ORACLE["feature_named_hour"] = _long_sql(
    _latest_sql("(SELECT *, event_id % 24 AS hour, event_id % 31 AS day FROM events)", "user_id", EV_ORDER,
                "user_id, hour, day", EV_LIVE),
    "fs:events", "user_id", [("hour", "CAST(hour AS VARCHAR)"), ("day", "CAST(day AS VARCHAR)")])

_NULLED = ("(SELECT event_id, ts, event_type, value, props, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id "
           "FROM events)")
ORACLE["quarantine"] = f"""SELECT (SELECT count(*) FROM {_NULLED} AS q WHERE user_id IS NULL) AS quarantined, c.*
                           FROM ({_counts_sql(_NULLED + ' AS q', "user_id", EV_ORDER, EV_LIVE)}) AS c"""

ORACLE["key_count"] = f"""SELECT (SELECT count(*) FROM ({EV_LATEST}) AS a)
                               + (SELECT count(*) FROM ({OR_LATEST}) AS b) AS keys"""
ORACLE["replace_to_empty"] = "SELECT '' AS key WHERE false"
ORACLE["delete_last_key"] = "SELECT CAST(0 AS BIGINT) AS keys"

_MERGED_NEW = _long_sql(EV_LATEST, "fs:events", "user_id", [
    f if f[0] != "value" else ("value", "CAST(CASE WHEN user_id % 2 = 1 THEN value END AS VARCHAR)") for f in EV_FIELDS])
ORACLE["merge_overlay"] = f"""
    SELECT coalesce(n.key, o.key) AS key, coalesce(n.field, o.field) AS field, coalesce(n.value, o.value) AS value
    FROM ({EV_LONG_OLD}) AS o FULL OUTER JOIN ({_MERGED_NEW}) AS n ON o.key = n.key AND o.field = n.field"""

_TTL_OLD = _long_sql(f"SELECT * FROM ({EV_CHANGES_OLD}) AS l WHERE ts + INTERVAL {TTL_SECONDS} SECOND > TIMESTAMP '{TTL_CLOCK}'",
                     "fs:events", "user_id", EV_FIELDS)
_TTL_NEW = _long_sql(f"SELECT * FROM ({EV_LATEST}) AS l WHERE user_id % 3 = 0", "fs:events", "user_id",
                     [f for f in EV_FIELDS if f[0] != "value"])
ORACLE["ttl_merge"] = f"""
    SELECT coalesce(n.key, o.key) AS key, coalesce(n.field, o.field) AS field, coalesce(n.value, o.value) AS value
    FROM ({_TTL_OLD}) AS o FULL OUTER JOIN ({_TTL_NEW}) AS n ON o.key = n.key AND o.field = n.field"""

ORACLE["sampled_diff"] = _DIFF_SQL + f"""SELECT key, status, n_mismatched FROM d WHERE status <> 'extra' AND key IN (
    SELECT key FROM (SELECT DISTINCT key FROM el) AS k ORDER BY md5(key), key LIMIT {SAMPLE})"""


def _unit_sql(name: str) -> str:
    return (f"(CAST('0x' || substr(md5('{GEN_SALT}' || cid || CAST(v AS VARCHAR) || '{name}'), 1, 8) AS BIGINT) "
            "/ 4294967296.0)")


_BASE = "TIMESTAMP '2025-03-10 06:00:00'"
ORACLE["generated_values"] = f"""
WITH e AS (SELECT format('C{{:06d}}', c_custkey) AS cid FROM customer),
f AS (SELECT cid, CAST('0x' || substr(md5('{GEN_SALT}' || 'v' || cid), 1, 8) AS BIGINT) % 3 + 1 AS n,
             CAST('0x' || substr(md5('{GEN_SALT}' || 'h' || cid), 1, 8) AS BIGINT) % 3 AS rot,
             CAST('0x' || substr(md5('{GEN_SALT}' || 'd' || cid), 1, 8) AS BIGINT) / 4294967296.0
                 < {GEN_TOMBSTONE_SHARE} AS tomb FROM e),
r AS (SELECT cid, v, (v + rot) % 3 AS hour_idx, false AS is_deleted
      FROM (SELECT cid, rot, unnest(range(0, n)) AS v FROM f) AS x
      UNION ALL SELECT cid, 3 AS v, 2 AS hour_idx, true FROM f WHERE tomb),
t AS (SELECT *, {_BASE} + to_hours(CAST(hour_idx AS BIGINT))
             + to_minutes(CAST(CASE WHEN is_deleted THEN 50 + floor({_unit_sql('m')} * 10) ELSE floor({_unit_sql('m')} * 50) END AS BIGINT))
             + to_milliseconds(CAST(floor({_unit_sql('s')} * 60) * 1000 + floor({_unit_sql('ms')} * 1000) AS BIGINT)) AS ev FROM r)
SELECT cid AS customer_id, strftime(ev, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_time,
       round({_unit_sql('fraud')}, 6) AS fraud_score, CAST(300 + floor({_unit_sql('credit')} * 701) AS BIGINT) AS credit_score,
       round(20 + {_unit_sql('ticket')} * 4980, 2) AS avg_ticket_30d, CAST(floor({_unit_sql('tx')} * 121) AS BIGINT) AS tx_count_24h,
       round({_unit_sql('trust')}, 4) AS device_trust,
       list_extract(['retail', 'premium', 'private', 'digital'], CAST(floor({_unit_sql('seg')} * 4) AS BIGINT) + 1) AS segment,
       {_unit_sql('pep')} < 0.02 AS is_pep,
       strftime(ev + INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%S.%g') AS api_invocation_time,
       strftime(ev + to_minutes(CAST(5 + floor({_unit_sql('w')} * 10) AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%g') AS write_time,
       is_deleted
FROM t"""

ORACLE["generated_tombstones"] = f"""SELECT cid AS customer_id FROM (SELECT format('C{{:06d}}', c_custkey) AS cid FROM customer) AS e
    ORDER BY CAST('0x' || substr(md5('{GEN_SALT}' || 'd' || cid), 1, 8) AS BIGINT), cid LIMIT {GEN_TOMBSTONES}"""
ORACLE["concurrent_merge"] = f"""
    SELECT coalesce(n.key, o.key) AS key, coalesce(n.field, o.field) AS field, coalesce(n.value, o.value) AS value
    FROM ({EV_LONG_OLD}) AS o FULL OUTER JOIN ({EV_LONG}) AS n ON o.key = n.key AND o.field = n.field"""
ORACLE["change_sets_on_read"] = ORACLE["change_sets_folded"] = ORACLE_TYPED_VIEW
ORACLE["expiry_sweep"] = ORACLE["ttl_live_keys"]
ORACLE["observed_writes"] = f"""SELECT step, n AS records FROM (SELECT count(*) AS n FROM ({EV_LATEST}) AS s) AS c,
    (SELECT unnest(['replace', 'changes', 'stored']) AS step) AS x"""
ORACLE["digest_reconcile"] = f"""
    SELECT 'fs:events:' || CAST(user_id AS VARCHAR) AS key, CASE WHEN user_id = {FAULTS[0]} THEN 'missing' ELSE 'changed' END AS status,
           CASE WHEN user_id = {FAULTS[0]} THEN '' ELSE 'value' END AS mismatched
    FROM ({EV_LATEST}) AS s WHERE user_id = {FAULTS[0]} OR (user_id = {FAULTS[1]} AND value IS NOT NULL)
    UNION ALL SELECT 'fs:events:-1', 'extra', '' FROM (SELECT count(*) AS n FROM ({EV_LATEST}) AS s) AS c WHERE n > 0"""
ORACLE["late_arrivals"] = f"""
WITH a AS (SELECT ts, epoch_us(ts) + CASE WHEN event_id % 13 = 0 THEN {LATE_HOURS} * 3600000000 ELSE 0 END AS arrival FROM events WHERE ts IS NOT NULL),
b AS (SELECT min(arrival) AS lo, max(arrival) AS hi FROM a),
s AS (SELECT ts, (arrival - lo) * {HOURLY_SLICES} // (hi - lo + 1) AS slice FROM a, b),
w AS (SELECT p.slice, max(q.ts) - INTERVAL {HOURLY_LATENESS_MINUTES} MINUTE AS wm
      FROM (SELECT DISTINCT slice FROM s) AS p LEFT JOIN s AS q ON q.slice < p.slice GROUP BY p.slice)
SELECT date_trunc('hour', ts) AS window_start,
       count(*) FILTER (WHERE wm IS NULL OR date_trunc('hour', ts) + INTERVAL 1 HOUR > wm) AS on_time,
       count(*) FILTER (WHERE wm IS NOT NULL AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= wm) AS late
FROM s JOIN w ON w.slice = s.slice GROUP BY 1"""
