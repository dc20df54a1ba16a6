"""Reads over the online table: typed view, point/batch gets, counts, read-time aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.text import parse_number
from .encode import FIELDS, KEY, TYPED, field_value

GROUP = "feature_group"


def in_group(online: DataFrame, c: Contract) -> DataFrame:
    """Keys of one feature group: partition pruning on the group plus exact prefix."""
    df = online
    if GROUP in online.columns:
        df = df.filter(F.col(GROUP) == c.feature_group)
    return df.filter(F.col(KEY).startswith(c.key_prefix + ":"))


def typed_view(online: DataFrame, c: Contract, view_name: str | None = None) -> DataFrame:
    """The search-index equivalent: entity as TAG text, features typed by index type.

    NUMERIC fields parse back to double (``nan``/``inf``/``1e-05`` included),
    TAG fields stay text. The event time is stored but not indexed, so it is
    not part of the view. Optionally registered as a temp view. Rows read with the
    contract's typed columns use those; others are parsed from the field map.
    """
    def column(name: str, kind: str) -> Column:
        if TYPED + name in online.columns:
            return F.col(f"`{TYPED}{name}`").alias(name)
        v = field_value(name)
        return (parse_number(v) if kind == "NUMERIC" else v).alias(name)

    cols = [column(c.entity_column, "TAG")] + [column(n, k) for n, k in c.features if n != c.entity_column]
    view = in_group(online, c).select(F.col(KEY), *cols)
    if view_name:
        view.createOrReplaceTempView(view_name)
    return view


def index_view_name(c: Contract) -> str:
    """Temp-view name for ``idx:{prefix}`` (SQL identifiers cannot hold ':')."""
    return "idx_" + "".join(ch if ch.isalnum() else "_" for ch in c.key_prefix)


def get(online: DataFrame, key: str) -> DataFrame:
    """All fields of one key (HGETALL); zero or one row."""
    return online.filter(F.col(KEY) == key).select(KEY, FIELDS)


def select_fields(online: DataFrame, names: Sequence[str]) -> DataFrame:
    """Chosen fields as text columns (HMGET); absent fields are null."""
    return online.select(F.col(KEY), *[field_value(n).alias(n) for n in names])


def batch_get(online: DataFrame, wanted: DataFrame, c: Contract, entity_column: str | None = None) -> DataFrame:
    """Stored record for each wanted entity (missing ones get nulls): one left join on the key.

    Spark picks the join from sizes it knows at run time and splits hot keys; no side is forced.
    """
    ec = entity_column or c.entity_column
    spine = wanted.select(F.col(ec), F.concat(F.lit(c.key_prefix + ":"), F.col(ec).cast("string")).alias(KEY))
    return spine.join(in_group(online, c).select(KEY, FIELDS), KEY, "left")


def key_count(online: DataFrame, c: Contract | None = None) -> DataFrame:
    """Number of keys (DBSIZE), or of one group's keys (prefix scan count)."""
    df = in_group(online, c) if c is not None else online
    return df.agg(F.count("*").alias("keys"))


def keys_per_group(online: DataFrame) -> DataFrame:
    return online.groupBy(GROUP).agg(F.count("*").alias("keys"))


def aggregate(view: DataFrame, group_by: str | Sequence[str], reducers: dict[str, Column],
              sort_by: Sequence[Column] | None = None, where: Column | None = None,
              apply: dict[str, Column] | None = None) -> DataFrame:
    """Read-time aggregation: optional filter, computed fields, group, reduce, sort.

    ``where=None`` is the match-all query; ``apply`` adds computed fields
    before grouping; ``reducers`` maps output name -> aggregate expression.
    """
    df = view
    if where is not None:
        df = df.filter(where)
    for name, expr in (apply or {}).items():
        df = df.withColumn(name, expr)
    keys = [group_by] if isinstance(group_by, str) else list(group_by)
    out = df.groupBy(*keys).agg(*[e.alias(n) for n, e in reducers.items()])
    if sort_by:
        out = out.orderBy(*sort_by)
    return out


def register_index(spark: SparkSession, online: DataFrame, c: Contract) -> str:
    """Create (or replace: idempotent) the typed view for a feature group."""
    name = index_view_name(c)
    typed_view(online, c, view_name=name)
    return name
