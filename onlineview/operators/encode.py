"""Snapshot -> online records: keys, flat hash fields, JSON documents.

All encodings are native expressions over the snapshot's own partitions, so
the shuffle done by the snapshot (hash of the entity) is reused as is: keys
are a function of the entity, no re-partitioning is needed to write them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Contract
from ..functions.text import field_text, iso_timestamp

KEY = "key"
FIELDS = "fields"
DOC = "doc"
#: Prefix of the online table's typed feature columns.
TYPED = "f_"

MODES = ("contract", "all")


def online_key(c: Contract, entity: Column | str | None = None) -> Column:
    """``{prefix}:{entity}``; null entity -> null key (quarantined upstream)."""
    e = F.col(entity or c.entity_column) if not isinstance(entity, Column) else entity
    return F.concat(F.lit(c.key_prefix + ":"), e.cast("string"))


def written_columns(df: DataFrame, c: Contract, mode: str = "contract",
                    keep_metadata: bool = False) -> list[str]:
    """Columns that become fields of the online record.

    ``contract``: entity, event time and the contract features (missing ones
    skipped). ``all``: every column except feature-store metadata (unless
    ``keep_metadata``); columns that partition discovery added are dropped
    where the history is read (``drop_partition_columns``).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "contract":
        cols = [x for x in c.contract_columns() if x in df.columns]
        if keep_metadata:
            cols += [m for m in c.metadata_columns if m in df.columns and m not in cols]
        return cols
    skip = set() if keep_metadata else set(c.metadata_columns) - set(c.contract_columns())
    return [x for x in df.columns if x not in skip]


def needed(hist: DataFrame, c: Contract, mode: str = "contract", keep_metadata: bool = False) -> DataFrame:
    """Written columns, ranking columns and the tombstone flag of a history: what has to be ranked and shuffled.

    Full ties are then ranked by the written columns, which is all that can differ in the result.
    """
    need = {*written_columns(hist, c, mode, keep_metadata), c.entity_column, c.event_time_column,
            c.write_time_column, c.deleted_column, *c.tiebreak_columns}
    return hist.select(*[x for x in hist.columns if x in need])


def project(df: DataFrame, c: Contract, mode: str = "contract", keep_metadata: bool = False) -> DataFrame:
    """Projection of a snapshot onto the written columns (typed, not text)."""
    return df.select(*written_columns(df, c, mode, keep_metadata))


def _text_columns(df: DataFrame, cols: list[str], exact_floats: bool) -> list[tuple[str, Column]]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [(n, field_text(F.col(n), types[n], exact_floats)) for n in cols]


def fields_column(df: DataFrame, c: Contract, mode: str = "contract", keep_metadata: bool = False,
                  exact_floats: bool = True) -> Column:
    """MAP<STRING,STRING> of the written columns' text, null-valued fields omitted."""
    cols = written_columns(df, c, mode, keep_metadata)
    pairs = _text_columns(df, cols, exact_floats)
    m = F.map_from_arrays(F.array(*[F.lit(n) for n, _ in pairs]), F.array(*[v for _, v in pairs]))
    return F.map_filter(m, lambda k, v: v.isNotNull())


def hash_fields(df: DataFrame, c: Contract, mode: str = "contract", keep_metadata: bool = False,
                exact_floats: bool = True, extra: list[str] | None = None) -> DataFrame:
    """(key, fields MAP<STRING,STRING>) with null-valued fields omitted."""
    m = fields_column(df, c, mode, keep_metadata, exact_floats)
    return df.select(online_key(c).alias(KEY), m.alias(FIELDS), *[F.col(x) for x in (extra or [])])


def long_fields(df: DataFrame, c: Contract, mode: str = "contract", keep_metadata: bool = False,
                exact_floats: bool = True) -> DataFrame:
    """(key, field, value): one row per non-null field; the comparable shape."""
    cols = written_columns(df, c, mode, keep_metadata)
    pairs = _text_columns(df, cols, exact_floats)
    arr = F.array(*[F.struct(F.lit(n).alias("field"), v.alias("value")) for n, v in pairs])
    return (df.select(online_key(c).alias(KEY), F.inline(arr))
              .filter(F.col("value").isNotNull()))


def explode_fields(online: DataFrame) -> DataFrame:
    """Stored (key, fields) -> (key, field, value)."""
    return online.select(KEY, F.explode(FIELDS).alias("field", "value"))


def doc_column(df: DataFrame, c: Contract, mode: str = "all", keep_metadata: bool = False) -> Column:
    """Typed JSON document of the written columns; nulls kept, timestamps as ISO text."""
    cols = written_columns(df, c, mode, keep_metadata)
    types = {f.name: f.dataType for f in df.schema.fields}
    members = []
    for n in cols:
        dt = types[n]
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            members.append(iso_timestamp(F.col(n), dt).alias(n))
        elif isinstance(dt, T.DateType):
            members.append(F.col(n).cast("string").alias(n))
        else:
            members.append(F.col(n))
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


def json_docs(df: DataFrame, c: Contract, mode: str = "all", keep_metadata: bool = False) -> DataFrame:
    """(key, doc): typed JSON document per entity."""
    return df.select(online_key(c).alias(KEY), doc_column(df, c, mode, keep_metadata).alias(DOC))


def field_value(name: str) -> Column:
    """One stored field of the (key, fields) shape, as text; absent -> null."""
    return F.element_at(F.col(FIELDS), F.lit(name))
