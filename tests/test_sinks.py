"""Online table (replace/merge, TTL), key-value sink, exports, reconcile, job gate."""

import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from onlineview.contract import Contract
from onlineview.operators import encode as ENC
from onlineview.operators import online as ON
from onlineview.operators import reconcile as RC
from onlineview.operators import snapshot as S
from onlineview.plans import job as J
from onlineview.plans import roles as R
from onlineview.sinks import export as EX
from onlineview.sinks import kv as KV
from onlineview.sinks import online_table as OT
from onlineview.sources.history import read_history

C = Contract.from_dict({
    "feature_group": "g", "entity_column": "id", "event_time_column": "t", "key_prefix": "fs:g",
    "features": {"x": "NUMERIC"},
})
SCHEMA = "id string, t timestamp, x double, is_deleted boolean"
T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
SF = "/root/testdata/sf0.01"


def store_fields(spark, root, group="g"):
    return {r["key"]: r["fields"] for r in OT.read_online(spark, root, group).collect()}


def write(spark, root, rows, mode, c=C):
    snap = S.latest(spark.createDataFrame(rows, SCHEMA), c.with_(deleted_column="is_deleted"))
    OT.write_online(spark, OT.records(snap, c), root, c, mode=mode)


def test_replace_removes_stale_keys_and_fields(spark, tmp_path):
    root = str(tmp_path / "online")
    write(spark, root, [("a", T1, 1.0, False), ("b", T1, 2.0, False)], "replace")
    write(spark, root, [("a", T2, None, False), ("b", T2, 2.0, True)], "replace")
    assert store_fields(spark, root) == {"fs:g:a": {"id": "a", "t": "2024-01-02T00:00:00+00:00"}}


def test_merge_keeps_stale_keys_and_fields(spark, tmp_path):
    root = str(tmp_path / "online")
    write(spark, root, [("a", T1, 1.0, False), ("b", T1, 2.0, False)], "merge")
    write(spark, root, [("a", T2, None, False), ("b", T2, 2.0, True)], "merge")
    got = store_fields(spark, root)
    assert got["fs:g:a"] == {"id": "a", "t": "2024-01-02T00:00:00+00:00", "x": "1.0"}
    assert "fs:g:b" in got  # stale: tombstoned since, still stored
    expected = ENC.hash_fields(S.latest(spark.createDataFrame(
        [("a", T2, None, False), ("b", T2, 2.0, True)], SCHEMA), C.with_(deleted_column="is_deleted")), C)
    d = {r["key"]: r["status"] for r in RC.diff(expected, OT.read_online(spark, root, "g")).collect()}
    assert d == {"fs:g:a": "changed", "fs:g:b": "extra"}


def test_groups_are_independent_and_prefix_exact(spark, tmp_path):
    root = str(tmp_path / "online")
    a = C.with_(feature_group="fs_a", key_prefix="fs:a")
    ab = C.with_(feature_group="fs_a_b", key_prefix="fs:a:b")
    write(spark, root, [("1", T1, 1.0, False)], "replace", a)
    write(spark, root, [("1", T1, 1.0, False), ("2", T1, 1.0, False)], "replace", ab)
    online = OT.read_online(spark, root)
    assert ON.key_count(online, a).first()["keys"] == 1
    assert ON.key_count(online, ab).first()["keys"] == 2
    assert ON.key_count(online).first()["keys"] == 3


def test_ttl_hides_expired_keys(spark, tmp_path):
    root = str(tmp_path / "online")
    c = C.with_(ttl_seconds=3600)
    snap = spark.createDataFrame([("a", T1, 1.0, False), ("b", T2, 1.0, False)], SCHEMA)
    OT.write_online(spark, OT.records(snap, c, ttl_anchor="event"), root, c)
    keys = [r["key"] for r in OT.read_online(spark, root, "g", clock="2024-01-01 12:00:00").collect()]
    assert keys == ["fs:g:b"]


def test_export_refuses_non_empty_target(spark, tmp_path):
    df = spark.createDataFrame([("a", T1, 1.0, False)], SCHEMA)
    path = str(tmp_path / "snap")
    EX.export_snapshot(df, path)
    with pytest.raises(Exception):
        EX.export_snapshot(df, path)
    assert EX.read_snapshot(spark, path).count() == 1


CLIENT = "kv_log:LogClient"


@pytest.fixture
def kv(spark):
    import kv_log
    spark.sparkContext.addPyFile(kv_log.__file__)
    return kv_log


def test_kv_sink_batches_connections_and_counts(spark, tmp_path, kv):
    url = str(tmp_path / "kv")
    recs = spark.range(1234).select(F.concat(F.lit("fs:g:"), F.col("id").cast("string")).alias("key"),
                                    F.create_map(F.lit("x"), F.col("id").cast("string")).alias("fields"))
    s = KV.write_kv(spark, recs, url, client=CLIENT, batch_size=100, partitions=4, ttl_seconds=60)
    batches = kv.commands(url)
    assert len({f.split("-")[0] for f in os.listdir(url)}) <= 4
    assert s["records"] == 1234 and s["commands"] == 2468 and s["flushes"] == len(batches)
    assert max(map(len, batches)) == 200  # 100 records, each with its deadline
    assert sum(c[0] == "expire" for b in batches for c in b) == 1234
    assert len(kv.state(url)) == 1234


def test_kv_hash_merge_and_delete(spark, tmp_path, kv):
    url = str(tmp_path / "kv")
    m = lambda d: F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])
    one = spark.range(1).select(F.lit("k1").alias("key"), m({"a": "1", "b": "2"}).alias("fields"))
    KV.write_kv(spark, one, url, client=CLIENT)
    two = spark.range(1).select(F.lit("k1").alias("key"), m({"a": "9"}).alias("fields"))
    KV.write_kv(spark, two, url, client=CLIENT, deletes=spark.range(1).select(F.lit("k2").alias("key")))
    assert kv.state(url) == {"k1": {"a": "9", "b": "2"}}
    KV.write_kv(spark, two.limit(0), url, client=CLIENT, deletes=spark.range(1).select(F.lit("k1").alias("key")))
    assert kv.state(url) == {}


def test_stream_into_kv(spark, tmp_path, kv):
    from onlineview.streaming import refresh as RF
    src, url = str(tmp_path / "src"), str(tmp_path / "kv")
    c = C.with_(deleted_column="is_deleted", ttl_seconds=60)
    spark.createDataFrame([("a", T1, 1.0, False), ("b", T1, 2.0, False)], SCHEMA).write.parquet(src + "/f1")
    for k, rows in enumerate(([], [("b", T2, 2.0, True), ("a", datetime(2023, 1, 1), 9.0, False)])):
        if rows:
            spark.createDataFrame(rows, SCHEMA).write.parquet(src + "/f2")
        RF.refresh(spark, src + "/*", spark.createDataFrame([], SCHEMA).schema, c, None, str(tmp_path / "ck"),
                   sink=RF.changes_to_kv(url, c, client=CLIENT)).awaitTermination()
    assert {k: v["x"] for k, v in kv.state(url).items()} == {"fs:g:a": "1.0"}


def test_empty_result_removes_everything(spark, tmp_path):
    root = str(tmp_path / "online")
    write(spark, root, [("a", T1, 1.0, False), ("b", T1, 2.0, False)], "replace")
    write(spark, root, [("a", T2, 1.0, True), ("b", T2, 2.0, True)], "replace")
    assert store_fields(spark, root) == {}
    write(spark, root, [("a", T1, 1.0, False)], "replace")
    none = OT.records(spark.createDataFrame([], SCHEMA), C)
    OT.apply_changes(spark, root, C, none, spark.createDataFrame([("fs:g:a",)], "key string"))
    assert store_fields(spark, root) == {}
    OT.apply_changes(spark, root, C, none, spark.createDataFrame([], "key string"))
    assert store_fields(spark, root) == {}


def _numbers(spark, n=500):
    return spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit(T1).alias("t"), F.lit(1.0).alias("x"))


NO_KEYS = "key string"


def test_change_sets_hold_only_their_keys_and_fold(spark, tmp_path):
    root = str(tmp_path / "online")
    OT.write_online(spark, OT.records(_numbers(spark), C), root, C, buckets=8)
    for k in range(4):
        one = _numbers(spark).filter("id = '7'").withColumn("x", F.lit(2.0 + k))
        done = OT.apply_changes(spark, root, C, OT.records(one, C), spark.createDataFrame([(f"fs:g:{k}",)], NO_KEYS))
        assert (done.written, done.version) == (2, k + 2)
    s = OT.state(spark, root, "g")
    assert s.number == 5 and sum(len(b.deltas) for b in s.buckets) <= 8
    base = {b.base for b in s.buckets}
    new = [f"{root}/data/feature_group=g/write={w}" for w in s.writes - base]
    assert len(base) == 1 and len(new) == 4 and spark.read.option("basePath", f"{root}/data").parquet(*new).count() == 8
    got = OT.read_online(spark, root, "g")
    assert got.count() == 496 and got.filter("key = 'fs:g:7'").first()["fields"]["x"] == "5.0"
    before = {tuple(sorted(r["fields"].items())) for r in got.collect()}
    OT.compact(spark, root, C, retain=0)
    after = OT.state(spark, root, "g")
    assert not any(b.deltas for b in after.buckets) and sum(b.keys for b in after.buckets) == 496
    assert {tuple(sorted(r["fields"].items())) for r in OT.read_online(spark, root, "g").collect()} == before
    OT.compact(spark, root, C, retain=0)  # nothing to do; what the first one replaced is old now
    assert {x.partition("=")[2] for x in os.listdir(root + "/data/feature_group=g")} == after.writes
    got = OT.read_online(spark, root, "g", key="fs:g:7")
    assert got.first()["fields"]["x"] == "5.0" and len({os.path.dirname(f) for f in got.inputFiles()}) == 1


def _in_buckets(df, n, chosen):
    return df.filter(OT.bucket_of(F.concat(F.lit("fs:g:"), "id"), n).isin(chosen))


@pytest.mark.parametrize("first", [0, 1])
def test_two_writers_from_one_version(spark, tmp_path, first):
    """Disjoint buckets both land; the loser of one bucket fails and the winner's rows stay."""
    root, df = str(tmp_path / "online"), _numbers(spark, 100)
    OT.write_online(spark, OT.records(df, C), root, C, buckets=4)
    start = OT.state(spark, root, "g")
    merges = [lambda: OT.write_online(spark, OT.records(_in_buckets(df, 4, [0, 1]).withColumn("x", F.lit(7.0)), C), root, C, mode="merge", start=start),
              lambda: OT.write_online(spark, OT.records(_in_buckets(df, 4, [2]).withColumn("x", F.lit(8.0)), C), root, C, mode="merge", start=start)]
    for k in (first, 1 - first):
        merges[k]()
    clash = OT.records(_in_buckets(df, 4, [1, 3]).withColumn("x", F.lit(9.0)), C)
    folders = set(os.listdir(root + "/data/feature_group=g"))
    for mode in ("merge", "replace"):
        with pytest.raises(OT.CommitConflict):
            OT.write_online(spark, clash, root, C, mode=mode, start=start)
    assert set(os.listdir(root + "/data/feature_group=g")) == folders
    OT.apply_changes(spark, root, C, OT.records(_in_buckets(df, 4, [3]).limit(1).withColumn("x", F.lit(5.0)), C), spark.createDataFrame([], NO_KEYS), start=start)
    xs = [float(r["fields"]["x"]) for r in OT.read_online(spark, root, "g").collect()]
    n = [_in_buckets(df, 4, [b]).count() for b in range(4)]
    assert sorted(xs) == sorted([7.0] * (n[0] + n[1]) + [8.0] * n[2] + [5.0] + [1.0] * (n[3] - 1))


def test_compaction_keeps_changes_that_came_in_meanwhile(spark, tmp_path):
    root, df, none = str(tmp_path / "online"), _numbers(spark, 40), spark.createDataFrame([], NO_KEYS)
    OT.write_online(spark, OT.records(df, C), root, C, buckets=2)
    OT.apply_changes(spark, root, C, OT.records(df.filter("id < 5").withColumn("x", F.lit(2.0)), C), none)
    start = OT.state(spark, root, "g")
    OT.apply_changes(spark, root, C, OT.records(df.filter("id = '3'").withColumn("x", F.lit(3.0)), C), none)
    OT.compact(spark, root, C, start=start)
    s = OT.state(spark, root, "g")
    assert sorted(len(b.deltas) for b in s.buckets) == [0, 1]
    assert {r["key"]: r["fields"]["x"] for r in OT.read_online(spark, root, "g").filter("fields.x <> '1.0'").collect()} == {
        f"fs:g:{k}": "3.0" if k == 3 else "2.0" for k in range(5)}
    OT.write_online(spark, OT.records(df, C), root, C)
    with pytest.raises(OT.CommitConflict):
        OT.compact(spark, root, C, start=start)


def test_a_reader_outlasts_later_commits(spark, tmp_path):
    root = str(tmp_path / "online")
    write(spark, root, [("a", T1, 1.0, False)], "replace")
    reader = OT.read_online(spark, root, "g")
    for _ in range(3):
        write(spark, root, [("b", T1, 1.0, False)], "replace")
    assert [r["key"] for r in reader.collect()] == ["fs:g:a"]
    OT.vacuum(spark, root, "g", retain=0)
    assert os.listdir(root + "/versions/feature_group=g") == ["version=4"] and len(os.listdir(root + "/data/feature_group=g")) == 1


def test_sweep_opens_due_buckets_only(spark, tmp_path):
    root, c = str(tmp_path / "online"), C.with_(ttl_seconds=60)
    df = _numbers(spark, 50).withColumn("t", F.when(OT.bucket_of(F.concat(F.lit("fs:g:"), "id"), 4) == 2, F.lit(T1)).otherwise(F.lit(T2)))
    OT.write_online(spark, OT.records(df, c, ttl_anchor="event"), root, c, buckets=4)
    before = OT.state(spark, root, "g")
    done = OT.sweep(spark, root, c, clock=datetime(2024, 1, 1, 12))
    after = OT.state(spark, root, "g")
    assert [a == b for a, b in zip(before.buckets, after.buckets)] == [True, True, False, True]
    assert after.buckets[2] == OT.Bucket() and done.written == 0
    assert OT.read_online(spark, root, "g", check_ttl=False).count() == 50 - before.buckets[2].keys
    assert OT.sweep(spark, root, c, clock=datetime(2024, 1, 1, 12)).version == after.number


def _scanned(df) -> int:
    """Rows that the file scans of an executed plan put out."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            rows += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
    return rows


def test_point_read_of_an_absent_key_skips_row_groups(spark, tmp_path):
    root = str(tmp_path / "online")
    OT.write_online(spark, OT.records(_numbers(spark, 2000).filter("id % 2 = 0"), C), root, C, buckets=2)
    assert _scanned(OT.read_online(spark, root, "g", key="fs:g:1000")) > 0
    assert [_scanned(OT.read_online(spark, root, "g", key=f"fs:g:{k}")) for k in (1001, 555, 999)] == [0, 0, 0]


def test_digests_open_differing_buckets_only(spark, tmp_path):
    root, snap = str(tmp_path / "online"), _numbers(spark, 300)
    expected = ENC.hash_fields(snap, C)
    OT.write_online(spark, OT.records(snap.filter("id <> '5'").withColumn("x", F.when(F.col("id") == "9", 4.0).otherwise(F.col("x"))), C), root, C, buckets=16)
    d, opened = RC.digest_diff(spark, expected, root, "g")
    assert {(r["key"], r["status"]) for r in d.filter("status <> 'same'").collect()} == {("fs:g:5", "missing"), ("fs:g:9", "changed")}
    assert opened == {OT.bucket_number(k, 16, spark) for k in ("fs:g:5", "fs:g:9")}
    assert {f.split("bucket=")[1].split("/")[0] for f in d.inputFiles() if "bucket=" in f} == {str(k) for k in opened}
    OT.apply_changes(spark, root, C, OT.records(snap.filter("id in ('5', '9')"), C), spark.createDataFrame([], NO_KEYS))
    assert RC.digest_diff(spark, expected, root, "g")[0].filter("status <> 'same'").count() == 0
    OT.compact(spark, root, C)
    assert RC.digest_diff(spark, expected, root, "g")[1] == set()


def test_typed_columns_prune_the_scan(spark, tmp_path):
    root = str(tmp_path / "online")
    write(spark, root, [("a", T1, 1.5, False), ("b", T1, None, False)], "replace")
    write(spark, root, [("b", T2, 2.5, False)], "merge")
    view = ON.typed_view(OT.read_online(spark, root, "g", typed=C), C)
    assert {tuple(r) for r in view.select("id", "x").collect()} == {("a", 1.5), ("b", 2.5)}
    assert {tuple(r) for r in view.collect()} == {tuple(r) for r in ON.typed_view(OT.read_online(spark, root, "g"), C).collect()}
    plan = view.filter("x > 2").select("x")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(f_x)" in plan.split("PushedFilters:")[1] and "map<" not in plan and "fields" not in plan


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "online")
    write(spark, root, [("a", T1, 1.0, False)], "replace")
    bad = OT.records(spark.createDataFrame([("b", T1, 1.0, False)], SCHEMA), C).withColumn(
        "doc", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception):
        OT.write_online(spark, bad, root, C)
    assert list(store_fields(spark, root)) == ["fs:g:a"]
    write(spark, root, [("b", T1, 1.0, False)], "merge")
    assert sorted(store_fields(spark, root)) == ["fs:g:a", "fs:g:b"]


def test_merge_ignores_expired_records(spark, tmp_path):
    root = str(tmp_path / "online")
    c = C.with_(ttl_seconds=60)
    old = spark.createDataFrame([("a", T1, 1.0, False), ("z", T1, 1.0, False)], SCHEMA)
    OT.write_online(spark, OT.records(old, c, ttl_anchor="event"), root, c)
    new = spark.createDataFrame([("a", T2, None, False)], SCHEMA)
    OT.write_online(spark, OT.records(new, C), root, C, mode="merge")
    assert store_fields(spark, root) == {"fs:g:a": {"id": "a", "t": "2024-01-02T00:00:00+00:00"}}
    OT.write_online(spark, OT.records(old, c, ttl_anchor="event"), root, c)
    OT.apply_changes(spark, root, C, OT.records(new, C), spark.createDataFrame([], "key string"))
    assert list(store_fields(spark, root)) == ["fs:g:a"]


def test_reading_where_nothing_was_written_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        OT.read_online(spark, str(tmp_path / "none"), "g")


def test_reconcile_detects_planted_faults(spark, tmp_path):
    ev = R.events(spark, SF)
    snap = S.latest(ev, R.EVENTS)
    expected = ENC.hash_fields(snap, R.EVENTS)
    k_missing, k_changed = [r["key"] for r in expected.select("key").orderBy("key").take(2)]
    stored = (expected.filter(F.col("key") != k_missing)
              .withColumn("fields", F.when(F.col("key") == k_changed,
                                           F.map_concat(F.col("fields"), F.create_map(F.lit("value"), F.lit("-1"))))
                          .otherwise(F.col("fields")))
              .unionByName(spark.createDataFrame([("fs:events:999999", {"user_id": "999999"})],
                                                 "key string, fields map<string,string>")))
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    counts = {r["status"]: r["keys"] for r in RC.summary(RC.diff(expected, stored)).collect()}
    assert counts == {"missing": 1, "changed": 1, "extra": 1, "same": 118}
    with pytest.raises(RC.ReconciliationError):
        RC.gate(RC.report(expected, stored))
    assert RC.report(expected, expected).ok


def test_job_end_to_end_online_table(spark, tmp_path):
    src = str(tmp_path / "hist")
    EX.append_history(R.events(spark, SF), src, "ts")
    root = str(tmp_path / "online")
    res = J.materialize(spark, src, R.EVENTS, online_root=root, sample=25)
    assert (res.raw_records, res.entities, res.tombstoned, res.live) == (10000, 150, 30, 120)
    assert res.ok and res.report.counts == {"same": 120}
    assert spark.table(res.index).count() == 120


def test_job_end_to_end_kv_and_contract_file(spark, tmp_path):
    src = str(tmp_path / "hist")
    R.events(spark, SF).write.parquet(src)
    cpath = tmp_path / "contract.json"
    cpath.write_text(json.dumps(R.EVENTS.to_dict()))
    from onlineview.sources.history import load_contract
    c = load_contract(spark, str(cpath))
    import kv_log
    spark.sparkContext.addPyFile(kv_log.__file__)
    url = str(tmp_path / "kv")
    res = J.materialize(spark, src, c, kv_url=url, kv_client="kv_log:LogClient", kv_reader="kv_log:read",
                        partitions=3, batch_size=50)
    assert res.ok and res.report.ok and res.live == res.written == 120
    with pytest.raises(ValueError):
        J.materialize(spark, src, c, kv_url=url)


def test_job_sets_rows_without_id_aside(spark, tmp_path):
    src = str(tmp_path / "hist")
    rows = [("a", T1, 1.0, False), (None, T2, 2.0, False), ("b", T1, 3.0, False)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(src)
    for c in (C, C.with_(event_time_column="")):
        res = J.materialize(spark, src, c, online_root=str(tmp_path / "online"))
        assert res.ok and (res.raw_records, res.quarantined, res.live, res.written) == (3, 1, 2, 2)


def test_job_prunes_and_exports_ready_snapshots(spark, tmp_path):
    src, exp = str(tmp_path / "hist"), str(tmp_path / "exp")
    R.events(spark, SF).write.parquet(src)
    needed = ENC.needed(read_history(spark, src), R.EVENTS)
    assert "props" not in needed.columns and {"user_id", "ts", "event_id", "is_deleted", "value"} <= set(needed.columns)
    J.materialize(spark, src, R.EVENTS, online_root=str(tmp_path / "a"), export_path=exp)
    res = J.materialize(spark, exp, R.EVENTS, online_root=str(tmp_path / "b"), ready_snapshot=True, recursive=True)
    assert res.ok and res.live == 120
    one, two = (store_fields(spark, str(tmp_path / x), "events") for x in "ab")
    assert one == two
    spark.table(f"parquet.`{src}`").createOrReplaceTempView("hist_view")
    assert J.materialize(spark, None, R.EVENTS, table="hist_view", online_root=str(tmp_path / "c")).live == 120


def test_empty_source_exits_2(tmp_path, spark):
    args = ["--source", str(tmp_path / "nothing"), "--contract", json.dumps(C.to_dict()), "--online-root", str(tmp_path / "o")]
    assert J.main(args) == 2


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from onlineview import session

    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: Conf())
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_job_json_target_and_export(spark, tmp_path):
    src = str(tmp_path / "hist")
    R.orders(spark, SF).write.parquet(src)
    root = str(tmp_path / "online")
    exp = str(tmp_path / "export")
    res = J.materialize(spark, src, R.ORDERS, online_root=root, target="json", export_path=exp)
    assert res.ok and res.live == 1000
    docs = OT.read_online(spark, root, "orders").select("doc").limit(5).collect()
    assert all(json.loads(r["doc"])["o_custkey"] is not None for r in docs)
    back = EX.read_snapshot(spark, exp)
    assert back.count() == 1000 and "is_deleted" not in back.columns


def test_scale_conf_sizes_from_input():
    from onlineview.session import scale_conf
    conf = scale_conf(100 << 40, executors_cores=8000, streaming_state=True)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert "RocksDB" in conf["spark.sql.streaming.stateStore.providerClass"]


def test_kv_replace_removes_stale_keys_and_fields(spark, tmp_path, kv):
    url, src = str(tmp_path / "kv"), str(tmp_path / "src")
    reader = CLIENT.partition(":")[0] + ":read"
    run = lambda **k: J.materialize(spark, src, C, kv_url=url, kv_client=CLIENT, kv_reader=reader, strict=False, **k)
    spark.createDataFrame([("a", T1, 1.0, False), ("b", T1, 2.0, False)], SCHEMA).write.parquet(src)
    os.makedirs(url)
    assert run().index == "idx:fs:g" and run().ok  # safe to repeat
    assert json.load(open(url + "/index.json"))[:2] == ["idx:fs:g", "fs:g:"]
    spark.createDataFrame([("a", T2, None, False)], SCHEMA).write.mode("overwrite").parquet(src)
    assert run().ok
    assert {k: sorted(v) for k, v in kv.state(url).items()} == {"fs:g:a": ["id", "t"]}
    with pytest.raises(ValueError, match="reader"):
        J.materialize(spark, src, C, kv_url=url, kv_client=CLIENT)


def test_kv_deadline_counts_from_the_event(spark, tmp_path, kv):
    url, src = str(tmp_path / "kv"), str(tmp_path / "src")
    spark.createDataFrame([("a", T1, 1.0, False)], SCHEMA).write.parquet(src)
    c = C.with_(ttl_seconds=60)
    J.materialize(spark, src, c, kv_url=url, kv_client=CLIENT, mode="merge", ttl_anchor="event", strict=False)
    assert [x[2] for b in kv.commands(url) for x in b if x[0] == "expireat"] == [int(T1.replace(tzinfo=timezone.utc).timestamp()) + 60]
