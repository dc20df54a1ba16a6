"""Source variants and a hot-entity history."""

import json

from pyspark.sql import functions as F

from onlineview.operators import snapshot as S
from onlineview.plans import roles as R
from onlineview.sources.history import load_contract, read_history, union_histories

SF = "/root/testdata/sf0.01"


def test_recursive_listing_with_suffix_filter(spark, tmp_path):
    ev = R.table(spark, SF, "events")
    ev.write.parquet(str(tmp_path / "a" / "b"))
    (tmp_path / "a" / "notes.txt").write_text("not parquet")
    df = read_history(spark, str(tmp_path / "a"), recursive=True, suffix=".parquet")
    assert df.count() == ev.count()
    assert "b" not in df.columns


def test_contract_from_uri_and_inline(spark, tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps(R.EVENTS.to_dict()))
    assert load_contract(spark, "file://" + str(p)) == R.EVENTS
    assert load_contract(spark, json.dumps(R.EVENTS.to_dict())) == R.EVENTS


def test_union_with_missing_columns(spark):
    ev = R.table(spark, SF, "events")
    u = union_histories([ev.filter("event_type = 'view'"), ev.filter("event_type != 'view'").drop("props")])
    assert u.count() == ev.count()
    assert u.filter("props is null").count() == ev.filter("event_type != 'view'").count()


def test_hot_entity_holding_a_third_of_rows(spark):
    ev = R.events(spark, SF)
    n = ev.count()
    # a third of all rows moved onto one entity: same result rule, one row shipped per task
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    snap = S.latest(hot, R.EVENTS)
    want = (hot.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
            .join(hot, ["user_id", "event_id"]).filter("not is_deleted"))
    assert sorted(r["event_id"] for r in snap.collect()) == sorted(r["event_id"] for r in want.collect())
    plan = snap._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert hot.filter("user_id = -1").count() > n // 4
