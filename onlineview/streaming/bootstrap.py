"""Hand-over from a batch snapshot to the refresh stream.

A group with a long history starts its stream from a snapshot instead of a replay. :func:`bootstrap` reads the history
once, in batch, keeps the winning row of each entity (tombstones included), publishes the live ones and leaves in the folder
``path``::

    path/files    the history's files that the snapshot has read (path, modification time)
    path/rows     the winners, marked; later the rows of adopted files, unmarked
    path/since    one row: files modified after this time belong to the stream; written last

:func:`refresh_from` starts the refresh stream over ``rows`` and the files modified after ``since``; older files are pruned from the
listing by their metadata and not opened. All of ``rows`` is in the first micro-batch, so its state holds the winner of
each entity from the start, one row each. A winner that bears the mark is already published: the sink leaves it alone.

No file falls between the two. Files are listed before the snapshot reads them, so a file that lands meanwhile is read by both, which is
harmless, as the latest version of an entity does not depend on how often a row comes. ``since`` lies ``overlap`` seconds before the
newest listed file. A file that shows up later with an older time (a slow rename) is in neither part; :func:`adopt`
finds such files by an anti join of the listing with ``files`` and hands their rows to the stream. Run it before a scheduled refresh.

Nulls: rows without an entity id are set aside, as everywhere. An empty history hands over nothing and the stream reads every file.
Ties and repeated rows: as in :mod:`..operators.snapshot`; the mark does not rank.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..contract import Contract
from ..operators import snapshot as S
from ..sinks import online_table as OT
from . import refresh as RF

#: Seconds before the newest listed file from which on the stream reads files, for writers that rename finished files late.
OVERLAP = 3600.0
#: Paths of missed files that one read names; more are read in turns.
PATHS_AT_ONCE = 1000

Adapter = Callable[[DataFrame], DataFrame]
Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class HandOver:
    path: str
    since: int | None  # microseconds; None: the history was empty


def _listing(spark: SparkSession, source: str) -> DataFrame:
    """path and modification time of a history's files; no content is read."""
    return spark.read.format("binaryFile").load(source).select(
        F.col("_metadata.file_path").alias("path"), F.unix_micros("_metadata.file_modification_time").alias("modified"))


def _modified_after(since: int) -> Column:
    return F.col("_metadata.file_modification_time") > F.timestamp_micros(F.lit(since))


def _mark(columns: list[str]) -> str:
    """A name for the mark that no column of the history has."""
    name = "__published"
    while name in columns:
        name += "_"
    return name


def _same(df: DataFrame) -> DataFrame:
    return df


def bootstrap(spark: SparkSession, source: str, schema: T.StructType, c: Contract, online_root: str | None, path: str, *,
              adapter: Adapter | None = None, sink: Sink | None = None, overlap: float = OVERLAP, mode: str = "contract",
              ttl_anchor: str = "write", buckets: int = OT.DEFAULT_BUCKETS) -> HandOver:
    """Publish the snapshot of the history as the online table (or through ``sink``, as one batch of changes), and
    leave in ``path`` what :func:`refresh_from` needs. ``path`` must be new; after a failure take another one."""
    if not c.dedupe_enabled:
        raise ValueError("a hand-over needs an event-time column: without one there is no latest version")
    _listing(spark, source).write.parquet(f"{path}/files")
    history = (adapter or _same)(spark.read.schema(schema).parquet(source))
    mark = _mark(history.columns)
    S.latest(history, c, drop_tombstones=False).withColumn(mark, F.lit(True)).write.parquet(f"{path}/rows")
    winners = spark.read.parquet(f"{path}/rows").drop(mark)
    if sink is not None:
        sink(winners, 0)
    else:
        live = S.not_deleted(c, winners)
        recs = OT.records(winners if live is None else winners.filter(live), c, mode=mode, ttl_anchor=ttl_anchor)
        OT.write_online(spark, recs, online_root, c, mode="replace", buckets=buckets)
    (spark.read.parquet(f"{path}/files").agg((F.max("modified") - F.lit(int(overlap * 1_000_000))).alias("since"))
          .write.parquet(f"{path}/since"))
    return handed_over(spark, path)


def handed_over(spark: SparkSession, path: str) -> HandOver:
    """The hand-over that a finished :func:`bootstrap` left in ``path``."""
    return HandOver(path, spark.read.schema("since long").parquet(f"{path}/since").first()[0])


def adopt(spark: SparkSession, source: str, schema: T.StructType, h: HandOver, *, adapter: Adapter | None = None) -> int:
    """Hand files to the stream that neither it nor the snapshot has: older than ``since``, yet not listed then. Their number.

    Rows are written before their files are noted; a repeated run after a failure hands rows over twice, which is harmless.
    """
    if h.since is None:
        return 0
    noted = spark.read.schema("path string, modified long").parquet(f"{h.path}/files")
    missed = _listing(spark, source).filter(F.col("modified") <= h.since).join(noted, "path", "left_anti")
    found, block = 0, []

    def hand() -> None:
        rows = (adapter or _same)(spark.read.schema(schema).parquet(source).filter(F.col("_metadata.file_path").isin([r[0] for r in block])))
        rows.withColumn(_mark(rows.columns), F.lit(False)).write.mode("append").parquet(f"{h.path}/rows")
        spark.createDataFrame(block, "path string, modified long").write.mode("append").parquet(f"{h.path}/files")

    for r in missed.toLocalIterator():  # paths of few files; their rows stay in Spark
        block.append((r["path"], r["modified"]))
        found += 1
        if len(block) == PATHS_AT_ONCE:
            hand()
            block = []
    if block:
        hand()
    return found


def refresh_from(spark: SparkSession, source: str, schema: T.StructType, c: Contract, online_root: str | None, checkpoint: str,
                 h: HandOver, *, adapter: Adapter | None = None, sink: Sink | None = None, max_files_per_trigger: int | None = None,
                 available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """:func:`..refresh.refresh`, with its state started from the hand-over ``h`` instead of the history's first file."""
    new = RF.history_stream(spark, source, schema, max_files_per_trigger=max_files_per_trigger)
    if h.since is not None:
        new = new.filter(_modified_after(h.since))
    new = (adapter or _same)(new)
    mark = _mark(new.columns)
    rows = RF.history_stream(spark, f"{h.path}/rows", T.StructType([*new.schema.fields, T.StructField(mark, T.BooleanType())]))
    every = rows.unionByName(new.withColumn(mark, F.lit(False)))
    write = sink or RF.changes_to_online(spark, online_root, c)

    def changed(batch: DataFrame, epoch_id: int) -> None:
        write(batch.filter(~F.col(mark)).drop(mark), epoch_id)
    return RF.start(S.latest_by_max_by(every, c, drop_tombstones=False, unranked=(mark,)), checkpoint, changed,
                    available_now=available_now, processing_time=processing_time)
