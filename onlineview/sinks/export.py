"""Snapshot export, snapshot import and history append (file sinks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import utc
from ..sources.history import read_history


def export_snapshot(snapshot: DataFrame, path: str) -> str:
    """Write the deduped snapshot as Parquet into a path that must not exist yet.

    ``errorifexists`` mirrors the "target prefix must be empty" rule of an
    UNLOAD: a re-run never mixes two snapshots. One file per partition (the
    snapshot is never funnelled through a single task); importers read the
    whole folder.
    """
    snapshot.write.mode("errorifexists").parquet(path)
    return path


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Import a ready snapshot (files with or without extension); no dedupe."""
    return read_history(spark, path, recursive=True)


def hour_columns(df: DataFrame, ts_column: str) -> list:
    """Zero-padded year/month/day/hour partition values of an event time
    (timestamp, zone-less timestamp or ISO text with ``Z``), in UTC."""
    ts = utc(F.col(ts_column), df.schema[ts_column].dataType)
    return [F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month"),
            F.date_format(ts, "dd").alias("day"), F.date_format(ts, "HH").alias("hour")]


def append_history(df: DataFrame, path: str, ts_column: str, *, writers: int = 1) -> str:
    """Append records to an hour-partitioned history ``year=/month=/day=/hour=``.

    A REBALANCE on the hour columns gives each hour directory few files, while AQE
    splits an hour that holds a large share of the data and merges tiny ones.
    ``writers`` appends that often, each time a share of the rows by content hash, as
    several independent writers would: every hour gets at least one file from each
    writer that has rows for it, and a hot hour is still split.
    """
    out = df.select("*", *hour_columns(df, ts_column))
    share = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(writers))
    if writers > 1:
        out = out.persist()  # the records are made once, not for each writer
    try:
        for k in range(writers):
            part = out if writers == 1 else out.filter(share == k)
            (part.hint("rebalance", "year", "month", "day", "hour")
                 .write.mode("append").partitionBy("year", "month", "day", "hour").parquet(path))
    finally:
        if writers > 1:
            out.unpersist()
    return path
