"""The driver tables in feature-history roles (source adapters + contracts).

E = events: entity user_id, event time ts, tie-break event_id, tombstone
    event_type = 'error', NUMERIC value, TAG event_type.
R = orders: entity o_custkey, event time o_orderdate (real ties), tie-break
    o_orderkey, tombstone o_orderstatus = 'F'.
V = conversations: entity conv_id, numeric event time turn, no write column,
    no tombstones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..contract import Contract
from ..sources.history import flag_column, read_history

EVENTS = Contract.from_dict({
    "feature_group": "events",
    "entity_column": "user_id",
    "event_time_column": "ts",
    "write_time_column": "event_id",
    "deleted_column": "is_deleted",
    "key_prefix": "fs:events",
    "ttl_seconds": 0,
    "features": {"value": "NUMERIC", "event_type": "TAG"},
})

ORDERS = Contract.from_dict({
    "feature_group": "orders",
    "entity_column": "o_custkey",
    "event_time_column": "o_orderdate",
    "write_time_column": "o_orderkey",
    "deleted_column": "is_deleted",
    "key_prefix": "fs:orders",
    "features": {"o_totalprice": "NUMERIC", "o_orderpriority": "TAG"},
})

CONVERSATIONS = Contract.from_dict({
    "feature_group": "conversations",
    "entity_column": "conv_id",
    "event_time_column": "turn",
    "key_prefix": "fs:conversations",
    "features": {"role": "TAG", "text": "TAG"},
})

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_history(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_column(table(spark, sf_dir, "events"), "is_deleted", "event_type = 'error'")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_column(table(spark, sf_dir, "orders"), "is_deleted", "o_orderstatus = 'F'")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")
