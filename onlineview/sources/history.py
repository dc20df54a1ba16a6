"""Readers for feature histories, snapshots and contracts.

All readers return lazy DataFrames: column pruning and filters written later
by the caller still reach the Parquet scan (``ReadSchema`` / ``PushedFilters``
/ ``PartitionFilters``).
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import PARTITION_COLUMNS, Contract


class EmptySource(RuntimeError):
    """The history location holds no data: an error, never an empty success."""


def _raise_empty(path, err: Exception | None = None):
    raise EmptySource(f"no Parquet data under {path}") from err


def read_history(spark: SparkSession, path: str | list[str], *, recursive: bool = False,
                 suffix: str | None = None, merge_schema: bool = False,
                 check_empty: bool = False) -> DataFrame:
    """Scan a Parquet history.

    Default: Hive partition discovery, so ``year=/month=/day=/hour=`` become
    (int) columns usable for partition pruning. ``recursive=True`` lists every
    file under the prefix instead (no partition columns), optionally only
    names ending in ``suffix``. Files without an extension are read either way.
    ``check_empty`` runs one cheap ``isEmpty`` probe (first non-empty split).
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    try:
        df = reader.parquet(*paths)
    except AnalysisException as e:
        if e.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            _raise_empty(paths, e)
        raise
    if check_empty and df.isEmpty():
        _raise_empty(paths)
    return df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table or temp view as a history (the SQL path's source)."""
    return spark.table(name)


def union_histories(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union of history pieces whose column sets differ (missing -> null)."""
    frames = list(frames)
    if not frames:
        raise EmptySource("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def flag_column(df: DataFrame, name: str, predicate: Column | str) -> DataFrame:
    """Source adapter: derive a boolean tombstone flag once, at the source."""
    pred = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.withColumn(name, pred.cast("boolean"))


def hour_partition_filter(df: DataFrame, upper: datetime | str) -> Column | None:
    """Coarse predicate on discovered hour partitions for ``event < upper``.

    Only partition columns appear in it, so Spark turns it into
    ``PartitionFilters`` and skips whole directories. Directories are laid out in
    UTC; the caller's own filter on the event time stays exact. Returns None when
    the history has no hour layout.
    """
    if not all(c in df.columns for c in PARTITION_COLUMNS):
        return None
    ts = F.to_timestamp(F.lit(upper)) if isinstance(upper, str) else F.lit(upper)
    ts = F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))
    part_start = F.make_timestamp_ntz(F.col("year"), F.col("month"), F.col("day"), F.col("hour"),
                                      F.lit(0), F.lit(0))
    return part_start < ts


def load_contract(spark: SparkSession, raw: str) -> Contract:
    """Contract from inline JSON, a local file, or any Hadoop-readable URI.

    Remote URIs are read through Spark itself (one file, whole text), so every
    file system the cluster can reach works without a separate client.
    """
    text = raw.strip()
    if text.startswith("{"):
        return Contract.from_json(text)
    if os.path.exists(raw):
        with open(raw) as fh:
            return Contract.from_dict(json.load(fh))
    row = spark.read.text(raw, wholetext=True).first()
    if row is None:
        raise FileNotFoundError(raw)
    return Contract.from_json(row[0])
