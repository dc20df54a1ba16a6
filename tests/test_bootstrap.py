"""A stream that starts from a batch snapshot: nothing is lost, nothing is read twice, tombstones of the snapshot hold."""

import os
from datetime import datetime
from urllib.parse import unquote, urlparse

import pytest

from onlineview.plans import roles as R
from onlineview.session import scratch_path
from onlineview.sinks import online_table as OT
from onlineview.streaming import bootstrap as BS

SCHEMA = "id string, t timestamp, x long, is_deleted boolean, __published string"
C = R.EVENTS.with_(entity_column="id", event_time_column="t", write_time_column="", key_prefix="fs:b", feature_group="b",
                   features=(("x", "NUMERIC"),))


def _day(n):
    return datetime(2024, 1, n)


class Group:
    """A small history in arrivals and what the online table holds."""

    def __init__(self, spark):
        self.spark = spark
        self.base, self.root, self.path, self.ck = (scratch_path(spark, n) for n in ("src", "online", "hand-over", "ck"))
        self.src, self.schema = f"{self.base}/*", spark.createDataFrame([], SCHEMA).schema

    def arrive(self, name, rows, age=0.0):
        """One file; ``age`` sets its time back by as many seconds."""
        df = self.spark.createDataFrame([(*r, "own column") for r in rows], SCHEMA).coalesce(1)
        df.write.parquet(f"{self.base}/{name}")
        for f in self.spark.read.parquet(f"{self.base}/{name}").inputFiles():
            p = unquote(urlparse(f).path)
            at = os.path.getmtime(p) - age
            os.utime(p, (at, at))

    def bootstrap(self, **kw):
        return BS.bootstrap(self.spark, self.src, self.schema, C, self.root, self.path, overlap=kw.pop("overlap", 0), **kw)

    def run(self, h, **kw):
        q = BS.refresh_from(self.spark, self.src, self.schema, C, self.root, self.ck, h, **kw)
        q.awaitTermination()
        return sum(p["numInputRows"] for p in q.recentProgress)

    def stored(self):
        return {r["key"][5:]: r["fields"]["x"] for r in OT.read_online(self.spark, self.root, "b").collect()}


def test_stream_goes_on_from_the_snapshot(spark):
    g = Group(spark)
    g.arrive("f1", [("a", _day(1), 1, False), ("a", _day(3), 3, False), ("b", _day(5), 5, True), ("c", _day(1), 1, None),
                    (None, _day(1), 9, False)], age=100)
    h = g.bootstrap()
    assert g.stored() == {"a": "3", "c": "1"}
    # late versions of a and of the deleted b, a newer c, a new d, a deletion of nothing
    g.arrive("f2", [("a", _day(2), 2, False), ("b", _day(4), 4, False), ("c", _day(2), 2, False), ("d", _day(1), 1, False),
                    ("e", _day(1), 1, True)])
    assert g.run(h) == 3 + 5  # winners a, b, c and the new rows; f1 is not opened again
    assert g.stored() == {"a": "3", "c": "2", "d": "1"}
    g.arrive("f3", [("a", _day(9), 9, True), ("b", _day(6), 6, False)])
    assert g.run(BS.handed_over(spark, g.path)) == 2
    assert g.stored() == {"b": "6", "c": "2", "d": "1"}


def test_only_changed_entities_are_written(spark):
    g = Group(spark)
    g.arrive("f1", [(k, _day(2), 2, False) for k in "abc"], age=100)
    h, seen = g.bootstrap(), []
    g.arrive("f2", [("a", _day(1), 1, False), ("b", _day(3), 3, False)])
    g.run(h, sink=lambda batch, epoch: seen.extend((r["id"], r["x"], r["__published"]) for r in batch.collect()))
    assert seen == [("b", 3, "own column")]


def test_late_renamed_file_is_adopted_once(spark):
    g = Group(spark)
    g.arrive("f1", [("a", _day(1), 1, False)], age=100)
    h = g.bootstrap()
    g.arrive("f2", [("a", _day(2), 2, False), ("z", _day(1), 1, False)], age=5000)  # older than the newest listed file
    g.run(h)
    assert g.stored() == {"a": "1"}  # in neither part as yet
    assert BS.adopt(spark, g.src, g.schema, h) == 1
    assert BS.adopt(spark, g.src, g.schema, h) == 0
    assert g.run(h) == 2
    assert g.stored() == {"a": "2", "z": "1"}


def test_adopts_more_files_than_one_read_names(spark, monkeypatch):
    monkeypatch.setattr(BS, "PATHS_AT_ONCE", 2)
    g = Group(spark)
    g.arrive("f0", [("a", _day(1), 1, False)], age=100)
    h = g.bootstrap()
    for k in "bcd":
        g.arrive(f"f-{k}", [(k, _day(1), 1, False)], age=5000)
    assert BS.adopt(spark, g.src, g.schema, h) == 3
    g.run(h)
    assert g.stored() == dict.fromkeys("abcd", "1")


def test_overlapping_files_are_harmless(spark):
    g = Group(spark)
    g.arrive("f1", [("a", _day(1), 1, False), ("b", _day(1), 1, True)])
    h = g.bootstrap(overlap=3600)
    assert g.run(h) == 2 + 2 and g.stored() == {"a": "1"}


def test_empty_history_hands_over_nothing(spark):
    g = Group(spark)
    g.arrive("f1", [])
    for f in spark.read.parquet(f"{g.base}/f1").inputFiles():
        os.remove(unquote(urlparse(f).path))
    h = g.bootstrap()
    assert h.since is None and g.stored() == {}
    assert BS.adopt(spark, g.src, g.schema, h) == 0
    g.arrive("f2", [("a", _day(1), 1, False)], age=100)
    g.run(h)
    assert g.stored() == {"a": "1"}


def test_needs_a_latest_version_and_a_new_folder(spark):
    g = Group(spark)
    g.arrive("f1", [("a", _day(1), 1, False)])
    with pytest.raises(ValueError):
        BS.bootstrap(spark, g.src, g.schema, C.with_(event_time_column=""), g.root, g.path)
    g.bootstrap()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        g.bootstrap()
