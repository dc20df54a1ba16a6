"""Feature contract: which columns form the entity, its ordering and its payload.

A contract is parsed once on the driver and only ever used to *build* Spark
plans; nothing in it travels to executors except column names and literals.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

INDEX_TYPES = ("NUMERIC", "TAG")

# Columns a feature store appends to every record. They are payload for the
# snapshot but are dropped from documents unless asked for (keep_metadata).
API_INVOCATION_COLUMN = "api_invocation_time"

# Partition columns produced by Hive-style discovery of the history layout.
PARTITION_COLUMNS = ("year", "month", "day", "hour")


class ContractError(ValueError):
    """The contract is malformed or does not fit the data it is applied to."""


@dataclass(frozen=True)
class Contract:
    feature_group: str
    entity_column: str
    key_prefix: str
    features: tuple[tuple[str, str], ...]
    event_time_column: str = ""
    write_time_column: str = ""
    deleted_column: str = ""
    ttl_seconds: int = 0
    # Final ordering keys for rows that tie on (event, write). Empty means
    # "all payload features in contract order", which makes the choice a pure
    # function of the row contents, independent of file or partition order.
    tiebreak_columns: tuple[str, ...] = field(default=())

    # ------------------------------------------------------------------ build
    @staticmethod
    def from_dict(d: Mapping) -> Contract:
        missing = [k for k in ("feature_group", "entity_column", "key_prefix", "features") if not d.get(k)]
        if missing:
            raise ContractError(f"contract is missing required fields: {missing}")
        feats = d["features"]
        if isinstance(feats, Mapping):
            pairs = tuple((str(k), str(v).upper()) for k, v in feats.items())
        else:
            pairs = tuple((str(k), str(v).upper()) for k, v in feats)
        bad = [f"{k}={v}" for k, v in pairs if v not in INDEX_TYPES]
        if bad:
            raise ContractError(f"unknown index types {bad}; expected one of {INDEX_TYPES}")
        ttl = int(d.get("ttl_seconds", 0) or 0)
        if ttl < 0:
            raise ContractError("ttl_seconds must be >= 0")
        return Contract(
            feature_group=str(d["feature_group"]),
            entity_column=str(d["entity_column"]),
            key_prefix=str(d["key_prefix"]),
            features=pairs,
            event_time_column=str(d.get("event_time_column") or ""),
            write_time_column=str(d.get("write_time_column") or ""),
            deleted_column=str(d.get("deleted_column") or ""),
            ttl_seconds=ttl,
            tiebreak_columns=tuple(d.get("tiebreak_columns") or ()),
        )

    @staticmethod
    def from_json(text: str) -> Contract:
        return Contract.from_dict(json.loads(text))

    def to_dict(self) -> dict:
        return {
            "feature_group": self.feature_group,
            "entity_column": self.entity_column,
            "event_time_column": self.event_time_column,
            "write_time_column": self.write_time_column,
            "deleted_column": self.deleted_column,
            "key_prefix": self.key_prefix,
            "ttl_seconds": self.ttl_seconds,
            "features": dict(self.features),
            "tiebreak_columns": list(self.tiebreak_columns),
        }

    def with_(self, **kw) -> Contract:
        return replace(self, **kw)

    # --------------------------------------------------------------- derived
    @property
    def feature_names(self) -> list[str]:
        return [n for n, _ in self.features]

    @property
    def dedupe_enabled(self) -> bool:
        return bool(self.event_time_column)

    @property
    def metadata_columns(self) -> list[str]:
        cols = [API_INVOCATION_COLUMN]
        if self.write_time_column:
            cols.append(self.write_time_column)
        if self.deleted_column:
            cols.append(self.deleted_column)
        return cols

    @property
    def index_name(self) -> str:
        return f"idx:{self.key_prefix}"

    def contract_columns(self) -> list[str]:
        """Entity, optional event time, then features (the written projection)."""
        cols = [self.entity_column]
        if self.event_time_column:
            cols.append(self.event_time_column)
        for f in self.feature_names:
            if f not in cols:
                cols.append(f)
        return cols

    # -------------------------------------------------------------- validate
    def validate(self, schema: T.StructType, strict: bool = True) -> Contract:
        """Check the contract against a history schema.

        strict=True raises on a feature, write time or deleted column that is not
        in the data; strict=False drops it from the returned contract (the lenient
        behaviour), so a misspelled flag cannot silently turn off tombstones.
        Nested and binary features are rejected in both modes: they have no
        flat text form.
        """
        names = set(schema.fieldNames())
        if self.entity_column not in names:
            raise ContractError(f"entity column {self.entity_column!r} not in data")
        if self.event_time_column and self.event_time_column not in names:
            raise ContractError(f"event time column {self.event_time_column!r} not in data")
        if self.deleted_column and self.deleted_column in names:
            dt = schema[self.deleted_column].dataType
            if not isinstance(dt, T.BooleanType):
                raise ContractError(
                    f"deleted column {self.deleted_column!r} must be boolean, got {dt.simpleString()}; "
                    "cast it once in the source adapter")
        unknown = [x for x in (self.write_time_column, self.deleted_column) if x and x not in names]
        if unknown and strict:
            raise ContractError(f"write time or deleted columns not in data: {unknown}")
        absent = [f for f in self.feature_names if f not in names]
        if absent and strict:
            raise ContractError(f"features not in data: {absent}")
        kept = tuple((n, t) for n, t in self.features if n in names)
        for n, _ in kept:
            dt = schema[n].dataType
            if isinstance(dt, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
                raise ContractError(f"feature {n!r} has unsupported type {dt.simpleString()}")
        bad_tb = [c for c in self.tiebreak_columns if c not in names]
        if bad_tb:
            raise ContractError(f"tiebreak columns not in data: {bad_tb}")
        cleared = {k: "" for k in ("write_time_column", "deleted_column") if getattr(self, k) in unknown}
        return self if kept == self.features and not cleared else self.with_(features=kept, **cleared)
