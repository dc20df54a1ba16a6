"""Edge rows of the snapshot rule (latest per entity, tombstones after ranking)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from onlineview.contract import Contract, ContractError
from onlineview.operators import snapshot as S
from onlineview.sources.history import EmptySource, read_history

C = Contract.from_dict({
    "feature_group": "g", "entity_column": "id", "event_time_column": "event_time",
    "write_time_column": "write_time", "deleted_column": "is_deleted", "key_prefix": "fs:g",
    "features": {"x": "NUMERIC"},
})
SCHEMA = "id string, event_time timestamp, write_time timestamp, is_deleted boolean, x long"

T1, T2 = datetime(2026, 8, 19, 12, 0), datetime(2026, 8, 19, 13, 0)
W1, W2, W9 = datetime(2026, 8, 19, 12, 5), datetime(2026, 8, 19, 13, 5), datetime(2026, 8, 19, 23, 0)


def snap(spark, rows, c=C, schema=SCHEMA, **kw):
    df = spark.createDataFrame(rows, schema)
    return sorted((r["id"], r["x"]) for r in S.latest(df, c, **kw).collect())


def both_forms(spark, rows, c=C, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    a = sorted(tuple(r) for r in S.latest(df, c).collect())
    b = sorted(tuple(r) for r in S.latest_by_max_by(df, c).select(*df.columns).collect())
    assert a == b
    return [(r[0], r[-1]) for r in a]


def test_latest_wins(spark):
    assert snap(spark, [("a", T1, W1, False, 1), ("a", T2, W2, False, 2)]) == [("a", 2)]


def test_tombstone_after_ranking(spark):
    assert snap(spark, [("a", T1, W1, False, 1), ("a", T2, W2, True, 2)]) == []


def test_recreated_entity_is_live(spark):
    assert snap(spark, [("a", T1, W1, True, 1), ("a", T2, W2, False, 2)]) == [("a", 2)]


def test_write_time_breaks_tie(spark):
    assert snap(spark, [("a", T1, W1, False, 1), ("a", T1, W2, False, 2)]) == [("a", 2)]


def test_full_tie_is_order_independent(spark):
    rows = [("a", T1, W1, False, 1), ("a", T1, W1, False, 2)]
    r1 = snap(spark, rows)
    r2 = snap(spark, list(reversed(rows)))
    df = spark.createDataFrame(rows * 50, SCHEMA).repartition(7)
    r3 = sorted((r["id"], r["x"]) for r in S.latest(df, C).collect())
    assert r1 == r2 == r3 == [("a", 2)]


def test_null_flag_is_live(spark):
    assert snap(spark, [("a", T1, W1, None, 1)]) == [("a", 1)]


def test_null_event_time_loses(spark):
    assert snap(spark, [("a", None, W9, False, 1), ("a", T1, W1, False, 2)]) == [("a", 2)]


def test_null_write_time_loses(spark):
    assert snap(spark, [("a", T1, None, False, 1), ("a", T1, W1, False, 2)]) == [("a", 2)]


def test_numeric_event_time_native_order(spark):
    c = C.with_(write_time_column="", deleted_column="")
    rows = [("a", 9.0, 1), ("a", 10.0, 2)]
    assert snap(spark, rows, c, "id string, event_time double, x long") == [("a", 2)]


def test_late_arrival_event_time_outranks_write(spark):
    assert snap(spark, [("a", T2, W1, False, 2), ("a", T1, W9, False, 1)]) == [("a", 2)]


def test_null_entity_quarantined(spark):
    df = spark.createDataFrame([(None, T1, W1, False, 1), ("a", T1, W1, False, 2)], SCHEMA)
    assert [r["id"] for r in S.latest(df, C).collect()] == ["a"]
    assert S.quarantined(df, C).count() == 1


def test_no_write_no_deleted_column(spark):
    c = C.with_(write_time_column="", deleted_column="")
    rows = [("a", T1, 1), ("a", T2, 2), ("b", T1, 3)]
    assert snap(spark, rows, c, "id string, event_time timestamp, x long") == [("a", 2), ("b", 3)]


def test_bypass_keeps_everything(spark):
    c = C.with_(event_time_column="")
    rows = [("a", T1, W1, True, 1), ("a", T2, W2, True, 2)]
    assert snap(spark, rows, c) == [("a", 1), ("a", 2)]


def test_max_by_equals_window(spark):
    rows = [("a", T1, W1, False, 1), ("a", T2, W2, True, 2), ("b", None, W9, False, 3), ("b", T1, None, False, 4),
            ("c", T1, W1, None, 5), ("c", T1, W1, False, 6), ("d", T2, W1, True, 7), ("d", T2, W2, False, 8)]
    assert both_forms(spark, rows) == [("b", 4), ("c", 6), ("d", 8)]


def test_counts(spark):
    rows = [("a", T1, W1, False, 1), ("a", T2, W2, True, 2), ("b", T1, W1, False, 3)]
    r = S.snapshot_counts(spark.createDataFrame(rows, SCHEMA), C).first()
    assert (r.raw_records, r.entities, r.tombstoned, r.live) == (3, 2, 1, 1)


def test_changes(spark):
    old = spark.createDataFrame([("a", T1, W1, False, 1), ("b", T1, W1, False, 2), ("c", T1, W1, False, 3)], SCHEMA)
    new = spark.createDataFrame([("a", T1, W1, False, 1), ("b", T2, W2, False, 5), ("d", T1, W1, False, 4)], SCHEMA)
    got = dict((r[0], r[1]) for r in S.snapshot_changes(S.latest(old, C), S.latest(new, C), C).collect())
    assert got == {"a": "same", "b": "changed", "c": "removed", "d": "added"}


def test_tombstone_filter_stays_above_window(spark):
    df = spark.createDataFrame([("a", T1, W1, False, 1), ("a", T2, W2, True, 2)], SCHEMA)
    plan = S.latest(df, C)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_input_order_invariance(spark):
    ev = read_history(spark, "/root/testdata/sf0.01/events.parquet").withColumn(
        "is_deleted", F.col("event_type") == "error")
    from onlineview.plans.roles import EVENTS
    a = sorted(tuple(r) for r in S.latest(ev, EVENTS).collect())
    b = sorted(tuple(r) for r in S.latest(ev.repartition(13, "value").sortWithinPartitions("value"), EVENTS).collect())
    assert a == b and len(a) == 120


def test_contract_strict_and_lenient(spark):
    df = spark.createDataFrame([("a", T1, W1, False, 1)], SCHEMA)
    c = C.with_(features=(("x", "NUMERIC"), ("typo", "TAG")))
    with pytest.raises(ContractError):
        c.validate(df.schema, strict=True)
    assert c.validate(df.schema, strict=False).feature_names == ["x"]


def test_contract_rejects_non_boolean_flag(spark):
    df = spark.createDataFrame([("a", T1, W1, "false", 1)],
                               "id string, event_time timestamp, write_time timestamp, is_deleted string, x long")
    with pytest.raises(ContractError):
        C.validate(df.schema)


def test_empty_source_is_an_error(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(EmptySource):
        read_history(spark, str(tmp_path / "empty"))


def test_changes_since_equals_two_snapshot_join(spark):
    ev = read_history(spark, "/root/testdata/sf0.01/events.parquet").withColumn(
        "is_deleted", F.col("event_type") == "error")
    from onlineview.plans.roles import EVENTS
    for cut in ["2024-01-10 00:00:00", "2024-01-30 00:00:00"]:
        a = sorted(tuple(r) for r in S.changes_since(ev, EVENTS, cut).collect())
        b = sorted(tuple(r) for r in S.snapshot_changes(S.snapshot_as_of(ev, EVENTS, cut),
                                                        S.latest(ev, EVENTS), EVENTS).collect())
        assert a == b


def test_changes_since_edge_rows(spark):
    rows = [("a", T1, W1, False, 1), ("a", T2, W2, True, 2),      # removed (tombstoned after cut)
            ("b", T2, W2, False, 3),                               # added
            ("c", T1, W1, True, 4), ("c", T2, W2, False, 5),       # deleted before, re-created: added
            ("d", T1, W1, False, 6), ("d", T2, W2, False, 6),      # same payload, newer time: changed (time)
            ("e", T1, W1, False, 7)]                               # same
    df = spark.createDataFrame(rows, SCHEMA)
    cut = datetime(2026, 8, 19, 12, 30)
    got = dict((r[0], r[1]) for r in S.changes_since(df, C, cut).collect())
    want = dict((r[0], r[1]) for r in S.snapshot_changes(S.snapshot_as_of(df, C, cut), S.latest(df, C), C).collect())
    assert got == want == {"a": "removed", "b": "added", "c": "added", "d": "changed", "e": "same"}


def test_tie_with_a_deletion_is_order_independent(spark):
    rows = [("a", T1, W1, False, 1), ("a", T1, W1, True, 1), ("b", T1, W1, True, 1), ("b", T1, W1, False, 9)]
    assert both_forms(spark, rows) == both_forms(spark, rows[::-1]) == []  # the deletion wins


def test_tie_outside_the_contract_is_order_independent(spark):
    schema = SCHEMA + ", note string, tags array<string>"
    rows = [("a", T1, W1, False, 1, "n1", ["x"]), ("a", T1, W1, False, 1, "n2", ["x"]), ("a", T1, W1, False, 1, "n2", ["y"])]
    for r in (rows, rows[::-1]):
        df = spark.createDataFrame(r, schema)
        for got in (S.latest(df, C).first(), S.latest_by_max_by(df, C).first()):
            assert (got["note"], got["tags"]) == ("n2", ["y"])


@pytest.mark.parametrize("kw", [{"deleted_column": "is_deletd"}, {"write_time_column": "wrte_time"}])
def test_unknown_ranking_columns_are_errors(spark, kw):
    schema = spark.createDataFrame([], SCHEMA).schema
    with pytest.raises(ContractError):
        C.with_(**kw).validate(schema)
    assert getattr(C.with_(**kw).validate(schema, strict=False), next(iter(kw))) == ""


def test_utc_does_not_depend_on_the_session(spark, tmp_path):
    from onlineview.functions.text import iso_millis_z
    from onlineview.sinks.export import append_history, hour_columns
    rows = [("a", "2024-01-01T00:30:00.250Z"), ("b", "2024-01-01T02:30:00.250+02:00"), ("c", "2024-01-01T00:30:00.250")]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame(rows, "id string, ts string")
            out = df.select(iso_millis_z("ts", df.schema["ts"].dataType).alias("z"), *hour_columns(df, "ts")).collect()
            assert {tuple(r) for r in out} == {("2024-01-01T00:30:00.250Z", "2024", "01", "01", "00")}
            typed = df.filter("id = 'a'").select(F.col("ts").cast("timestamp").alias("ts"))
            assert typed.select(iso_millis_z("ts", typed.schema["ts"].dataType)).first()[0] == "2024-01-01T00:30:00.250Z"
            path = str(tmp_path / zone.replace("/", "-"))
            append_history(typed, path, "ts")
            c = C.with_(event_time_column="ts")
            hist = read_history(spark, path)
            # the bound is an instant: half an hour after the event, in any zone
            upper = datetime(2024, 1, 1, 1, 0, tzinfo=__import__("datetime").timezone.utc)
            assert S.as_of(hist, c, upper).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_data_columns_named_like_partitions_stay(spark, tmp_path):
    df = spark.createDataFrame([("a", T1, W1, False, 1)], SCHEMA).withColumn("hour", F.lit(5))
    df.write.parquet(str(tmp_path / "flat"))
    flat = read_history(spark, str(tmp_path / "flat"))
    assert "hour" in S.drop_partition_columns(flat, C).columns
    df.drop("hour").withColumn("hour", F.lit(7)).write.partitionBy("hour").parquet(str(tmp_path / "laid"))
    laid = read_history(spark, str(tmp_path / "laid"))
    assert "hour" not in S.drop_partition_columns(laid, C).columns
