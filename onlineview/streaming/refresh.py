"""Incremental refresh of the online view with Structured Streaming.

New history files are picked up as they land (``readStream.parquet`` with a
checkpoint), reduced to the latest version per entity in streaming state, and
every micro-batch of changed entities is applied to the online store:
live records are upserted, entities whose latest version is a tombstone are
deleted.

State holds one winning row per entity -- tombstones included, so a late,
older version can never resurrect a deleted entity. There is deliberately no
watermark on this aggregation (it would evict entities and let stale rows win);
state therefore grows with the number of entities: use the RocksDB state store
provider for large groups (``rocksdb_conf``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..contract import Contract
from ..operators import snapshot as S
from ..operators.encode import KEY, online_key
from ..sinks import kv as KV
from ..sinks import online_table as OT

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def rocksdb_conf() -> dict[str, str]:
    return {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER}


def history_stream(spark: SparkSession, path: str, schema: T.StructType, *,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of a Parquet history as a stream (schema is required up front)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def latest_stream(stream: DataFrame, c: Contract) -> DataFrame:
    """Streaming latest-per-entity (update mode): the aggregate form of the rule."""
    return S.latest_by_max_by(stream, c, drop_tombstones=False)


def _split(batch: DataFrame, c: Contract) -> tuple[DataFrame, DataFrame]:
    """Live rows of a batch of changed entities, and the keys of deleted ones."""
    pred = S.not_deleted(c, batch)
    live = batch if pred is None else batch.filter(pred)
    gone = batch.limit(0) if pred is None else batch.filter(~pred)
    return live, gone.select(online_key(c).alias(KEY))


def changes_to_online(spark: SparkSession, root: str, c: Contract, *, ttl_anchor: str = "write",
                      mode: str = "contract", buckets: int = OT.DEFAULT_BUCKETS, compact_after: int = OT.COMPACT_AFTER) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for the online table: upsert live entities, delete tombstoned ones.

    A batch is one change set: files with its keys only. Buckets with ``compact_after`` change sets are folded.
    """
    def apply(batch: DataFrame, epoch_id: int) -> None:
        # the micro-batch is read twice (live, deleted): keep it instead of recomputing
        batch = batch.persist()
        try:
            live, deleted = _split(batch, c)
            OT.apply_changes(batch.sparkSession, root, c, OT.records(live, c, mode=mode, ttl_anchor=ttl_anchor),
                             deleted, buckets=buckets)
            OT.compact(batch.sparkSession, root, c, min_deltas=compact_after)
        finally:
            batch.unpersist()
    return apply


def changes_to_kv(url: str, c: Contract, *, client: str, mode: str = "contract", target: str = "hash",
                  partitions: int | None = None, batch_size: int = KV.DEFAULT_BATCH) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for a key-value store: the same changes as key writes and deletions.

    Writes are idempotent, so a replayed batch is harmless.
    """
    def apply(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            live, deleted = _split(batch, c)
            recs = live.select(online_key(c).alias(KEY), KV.payload(live, c, target, mode))
            KV.write_kv(batch.sparkSession, recs, url, deletes=deleted, client=client, target=target,
                        ttl_seconds=c.ttl_seconds, partitions=partitions, batch_size=batch_size)
        finally:
            batch.unpersist()
    return apply


def refresh(spark: SparkSession, source: str, schema: T.StructType, c: Contract, online_root: str | None,
            checkpoint: str, *, adapter: Callable[[DataFrame], DataFrame] | None = None,
            sink: Callable[[DataFrame, int], None] | None = None,
            max_files_per_trigger: int | None = None, available_now: bool = True,
            processing_time: str | None = None) -> StreamingQuery:
    """Start the refresh stream. ``available_now`` processes what is there and stops
    (a scheduled refresh); otherwise it runs every ``processing_time``. Changes go to the
    online table, or to ``sink`` (see :func:`changes_to_kv`)."""
    stream = history_stream(spark, source, schema, max_files_per_trigger=max_files_per_trigger)
    if adapter is not None:
        stream = adapter(stream)
    return start(latest_stream(stream, c), checkpoint, sink or changes_to_online(spark, online_root, c),
                 available_now=available_now, processing_time=processing_time)


def start(changes: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], *, available_now: bool = True,
          processing_time: str | None = None) -> StreamingQuery:
    """Run ``sink`` on each micro-batch of changed entities."""
    w = changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def hourly_arrivals(stream: DataFrame, ts_column: str, *, lateness: str = "15 minutes") -> DataFrame:
    """Records per event-time hour; a window is emitted once the watermark passes it.

    The watermark equals the history's buffering delay, so rows arriving up to
    that late are still counted; state is dropped for closed hours.
    """
    ts = F.col(ts_column).cast("timestamp")
    return (stream.withColumn("__ts", ts)
                  .withWatermark("__ts", lateness)
                  .groupBy(F.window("__ts", "1 hour").alias("w"))
                  .agg(F.count("*").alias("arrivals"))
                  .select(F.col("w.start").alias("window_start"), "arrivals"))


def split_arrivals(ts_column: str, out: str, *, lateness: str = "15 minutes") -> Callable[[DataFrame, int], None]:
    """foreachBatch function that counts records per event-time hour and keeps those that come after their hour has closed.

    An hour is closed once the highest event time of earlier batches lies ``lateness`` past its end. A batch writes its counts of
    open hours to ``out/arrivals``, its late rows, whole, to ``out/late`` and the highest event time so far to ``out/seen``,
    each in a folder of the batch that a replay writes again. :func:`arrivals` adds up the counts; nothing vanishes.
    """
    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark, here = batch.sparkSession, f"batch={epoch_id}"
        seen = "batch long, top timestamp"
        try:
            earlier = spark.read.schema(seen).parquet(f"{out}/seen").filter(F.col("batch") < epoch_id).agg(F.max("top")).first()[0]
        except AnalysisException as e:  # the first batch
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            earlier = None
        ts = F.col(ts_column).cast("timestamp")
        hour = F.window(ts, "1 hour")
        closed = F.lit(False) if earlier is None else hour["end"] <= F.lit(earlier) - F.expr(f"interval {lateness}")
        rows = batch.filter(ts.isNotNull()).withColumn("__closed", closed)
        rows.filter("__closed").drop("__closed").write.mode("overwrite").parquet(f"{out}/late/{here}")
        (rows.filter("NOT __closed").groupBy(hour["start"].alias("window_start")).agg(F.count(F.lit(1)).alias("arrivals"))
             .write.mode("overwrite").parquet(f"{out}/arrivals/{here}"))
        rows.agg(F.greatest(F.max(ts), F.lit(earlier).cast("timestamp")).alias("top")).write.mode("overwrite").parquet(f"{out}/seen/{here}")
    return apply


def arrivals(spark: SparkSession, out: str) -> DataFrame:
    """window_start, arrivals: what :func:`split_arrivals` has counted, added up over the batches."""
    got = spark.read.schema("window_start timestamp, arrivals long").parquet(f"{out}/arrivals")
    return got.groupBy("window_start").agg(F.sum("arrivals").alias("arrivals"))
