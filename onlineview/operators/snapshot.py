"""Latest-version-per-entity snapshot of an append-only history.

Rule: per entity, order versions by event time desc, write time desc, then a
deterministic payload tie-break; keep the first; drop it if it is a tombstone.
Nulls in the ordering keys always lose. Tombstones are removed *after* the
choice, so an entity whose newest version is a delete disappears, while a
delete followed by a newer live version leaves the entity live.

Physical plan (batch): ``row_number() ... = 1`` is recognised by Catalyst's
``WindowGroupLimit`` rule, which keeps one row per entity *before* the shuffle
(partial) and again after it (final). Each map task therefore ships at most one
row per entity it saw, so a hot entity holding a third of all rows costs one
row per task at the exchange, not a third of the data in one reducer.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import PARTITION_COLUMNS, Contract
from ..sources.history import hour_partition_filter

RN = "__rn"


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return isinstance(t, T.AtomicType) and not isinstance(t, T.VariantType)


def _flag(df: DataFrame, c: Contract) -> Column | None:
    if c.deleted_column and c.deleted_column in df.columns:
        return F.coalesce(F.col(c.deleted_column), F.lit(False))
    return None


def tiebreak_columns(df: DataFrame, c: Contract) -> list[str]:
    """Columns that order full ties after the deletion flag: the contract's features, then every
    other column that can be ordered, by name. Rows that agree in all of them are interchangeable."""
    used = {c.entity_column, c.event_time_column, c.write_time_column, c.deleted_column, *c.tiebreak_columns}
    fields = {f.name: f.dataType for f in df.schema.fields}
    names = [n for n in c.feature_names if n in fields] + sorted(set(fields) - set(c.feature_names))
    return [n for n in names if n not in used and _orderable(fields[n])]


def _order_parts(df: DataFrame, c: Contract) -> list[Column]:
    """Ranking keys, most significant first; larger is newer. A deletion beats a live version it ties with."""
    parts = [F.col(c.event_time_column)]
    if c.write_time_column and c.write_time_column in df.columns:
        parts.append(F.col(c.write_time_column))
    parts += [F.col(n) for n in c.tiebreak_columns]
    flag = _flag(df, c)
    if flag is not None:
        parts.append(flag)
    return parts + [F.col(n) for n in tiebreak_columns(df, c)]


def ordering(df: DataFrame, c: Contract) -> list[Column]:
    """Sort keys that rank versions of one entity, newest first."""
    return [p.desc_nulls_last() for p in _order_parts(df, c)]


def ordering_struct(df: DataFrame, c: Contract) -> Column:
    """The same order as one comparable struct (nulls compare lowest, so they lose)."""
    return F.struct(*[p.alias(f"o{i}") for i, p in enumerate(_order_parts(df, c))])


def not_deleted(c: Contract, df: DataFrame) -> Column | None:
    """Null-safe live predicate: a null flag counts as live."""
    flag = _flag(df, c)
    return None if flag is None else ~flag


def quarantined(df: DataFrame, c: Contract) -> DataFrame:
    """Rows without an entity id: never written, reported separately."""
    return df.filter(F.col(c.entity_column).isNull())


def latest(df: DataFrame, c: Contract, *, drop_tombstones: bool = True) -> DataFrame:
    """Latest version per entity (window form, the batch default).

    With an empty event-time column the history is returned unchanged: no
    dedupe and no tombstone filter (the documented bypass mode).
    """
    if not c.dedupe_enabled:
        return df
    w = Window.partitionBy(c.entity_column).orderBy(*ordering(df, c))
    out = (df.filter(F.col(c.entity_column).isNotNull())
             .withColumn(RN, F.row_number().over(w))
             .filter(F.col(RN) == 1)
             .drop(RN))
    live = not_deleted(c, df)
    if drop_tombstones and live is not None:
        out = out.filter(live)
    return out


def latest_by_max_by(df: DataFrame, c: Contract, *, drop_tombstones: bool = True, unranked: tuple[str, ...] = ()) -> DataFrame:
    """Same result as :func:`latest`, as an aggregate (``max_by`` over a struct).

    Partial aggregation keeps one candidate per entity per map task. This is
    the form Structured Streaming can keep in state (see streaming.refresh).
    Columns in ``unranked`` go along with their row and never break a tie.
    """
    if not c.dedupe_enabled:
        return df
    cols = df.columns
    payload = F.struct(*[F.col(x) for x in cols])
    out = (df.filter(F.col(c.entity_column).isNotNull())
             .groupBy(c.entity_column)
             .agg(F.max_by(payload, ordering_struct(df.drop(*unranked), c)).alias("__r"))
             .select("__r.*"))
    live = not_deleted(c, df)
    if drop_tombstones and live is not None:
        out = out.filter(live)
    return out


def as_of(df: DataFrame, c: Contract, upper: datetime | str) -> DataFrame:
    """History restricted to versions with event time strictly before ``upper``.

    On an hour-partitioned history a coarse predicate on the partition columns
    is added as well, so whole hour directories past ``upper`` are skipped.
    """
    ts = F.to_timestamp(F.lit(upper)) if isinstance(upper, str) else F.lit(upper)
    ev = F.col(c.event_time_column)
    if isinstance(df.schema[c.event_time_column].dataType, T.TimestampNTZType):
        ts = ts.cast("timestamp_ntz")
    out = df.filter(ev < ts)
    part = hour_partition_filter(df, upper)
    if part is not None:
        out = out.filter(part)
    return out


def snapshot_as_of(df: DataFrame, c: Contract, upper: datetime | str) -> DataFrame:
    return latest(as_of(df, c, upper), c)


def snapshot_counts(df: DataFrame, c: Contract) -> DataFrame:
    """raw records, entities, tombstoned entities and live entities in one job.

    The raw count and the ranked side are unioned and summed, so there is one
    global aggregate and no join; the ranked side still benefits from the
    partial top-1 before its shuffle.
    """
    deleted = F.coalesce(F.col(c.deleted_column), F.lit(False)) \
        if c.deleted_column and c.deleted_column in df.columns else F.lit(False)
    raw = df.select(F.lit(1).alias("r"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    ranked = latest(df, c, drop_tombstones=False).select(
        F.lit(0).alias("r"), F.lit(1).alias("e"), deleted.cast("int").alias("d"))
    return (raw.unionByName(ranked)
               .agg(F.sum("r").cast("long").alias("raw_records"),
                    F.sum("e").cast("long").alias("entities"),
                    F.sum("d").cast("long").alias("tombstoned"))
               .withColumn("live", F.col("entities") - F.col("tombstoned")))


def winner_counts(winners: DataFrame, c: Contract) -> DataFrame:
    """entities / tombstoned / live from already-ranked winners (one row per entity)."""
    deleted = F.coalesce(F.col(c.deleted_column), F.lit(False)) \
        if c.deleted_column and c.deleted_column in winners.columns else F.lit(False)
    return (winners.agg(F.count("*").alias("entities"), F.count_if(deleted).alias("tombstoned"))
                   .withColumn("live", F.col("entities") - F.col("tombstoned")))


def payload_columns(c: Contract, df: DataFrame) -> list[str]:
    return [x for x in c.contract_columns() if x in df.columns and x != c.entity_column]


def snapshot_changes(old: DataFrame, new: DataFrame, c: Contract,
                     columns: list[str] | None = None) -> DataFrame:
    """Classify each entity of two snapshots: added, removed, changed or same.

    One full outer equi-join on the entity; payload equality is null-safe.
    """
    cols = columns or payload_columns(c, new)
    e = c.entity_column
    o = old.select(F.col(e), F.struct(*[F.col(x) for x in cols]).alias("o"))
    n = new.select(F.col(e), F.struct(*[F.col(x) for x in cols]).alias("n"))
    j = o.join(n, e, "full_outer")
    status = (F.when(F.col("o").isNull(), "added")
               .when(F.col("n").isNull(), "removed")
               .when(F.col("o").eqNullSafe(F.col("n")), "same")
               .otherwise("changed"))
    return j.select(F.col(e), status.alias("change"))


def changes_since(df: DataFrame, c: Contract, upper: datetime | str,
                  columns: list[str] | None = None) -> DataFrame:
    """Same classification as :func:`snapshot_changes` for the common case
    "snapshot as of ``upper`` vs snapshot now" of one history, in one pass.

    One aggregate per entity keeps two winners: the newest version overall and
    the newest version with event time before ``upper`` (rows outside the
    as-of range get a null ordering, which ``max_by`` ignores). Map-side
    partial aggregation keeps one candidate pair per entity per task, so this
    needs one shuffle and no join.
    """
    cols = columns or payload_columns(c, df)
    ts = F.to_timestamp(F.lit(upper)) if isinstance(upper, str) else F.lit(upper)
    if isinstance(df.schema[c.event_time_column].dataType, T.TimestampNTZType):
        ts = ts.cast("timestamp_ntz")
    deleted = F.coalesce(F.col(c.deleted_column), F.lit(False)) \
        if c.deleted_column and c.deleted_column in df.columns else F.lit(False)
    payload = F.struct(*[F.col(x) for x in cols], deleted.alias("__d"))
    order = ordering_struct(df, c)
    e = c.entity_column
    agg = (df.filter(F.col(e).isNotNull())
             .groupBy(e)
             .agg(F.max_by(payload, order).alias("n"),
                  F.max_by(payload, F.when(F.col(c.event_time_column) < ts, order)).alias("o")))
    o_live = F.col("o").isNotNull() & ~F.col("o.__d")
    n_live = ~F.col("n.__d")
    same = F.struct(*[F.col(f"o.{x}") for x in cols]).eqNullSafe(F.struct(*[F.col(f"n.{x}") for x in cols]))
    status = (F.when(~o_live & n_live, "added")
               .when(o_live & ~n_live, "removed")
               .when(o_live & n_live & same, "same")
               .when(o_live & n_live, "changed"))
    return agg.select(F.col(e), status.alias("change")).filter(F.col("change").isNotNull())


def drop_partition_columns(df: DataFrame, c: Contract) -> DataFrame:
    """Columns that partition discovery added must not leak into the payload.

    ``df`` is a history as it was read. A column counts as discovered if the file paths
    name it, so a feature of the data itself that is called ``hour`` stays.
    """
    keep = set(c.contract_columns())
    named = [p for p in PARTITION_COLUMNS if p in df.columns and p not in keep]
    if not named:
        return df
    try:
        row = df.select("_metadata.file_path").first()  # all files of a history share one layout
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("UNRESOLVED_COLUMN"):  # not read from files
            return df
        raise
    return df.drop(*[p for p in named if row is None or f"/{p}=" in row[0]])
