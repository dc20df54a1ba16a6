"""Key-value sink: a PySpark Python Data Source that writes online records.

Each write task opens ONE client connection (so connections = write tasks;
cap them with ``partitions``), takes Arrow batches and flushes the commands of every
``batch_size`` records, non-transactionally, like a pipelined key-value
client. Per-key commands are idempotent upserts, so a retried task is harmless;
the written-record counter comes from the commit messages of *successful*
task attempts, never from side effects, so it is exact under retries.

The client is pluggable: ``client`` names ``module:factory``; the factory gets the
option ``url`` and returns an object with ``write_batch(commands)`` and ``close()``.
Commands are tuples ``("hset", key, {field: text})``, ``("hdel", key, [field])``, ``("json_set", key, doc)``,
``("expire", key, seconds)``, ``("expireat", key, epoch_seconds)`` and ``("del", key)``.
A client may also have ``create_index(name, prefix, schema)``, which must be safe to repeat: see :func:`create_index`.

Reading back is pluggable too: ``reader`` names ``module:function``, called as
``function(spark, url)``, which returns a DataFrame of (key, fields) or (key, doc).
"""

from __future__ import annotations

import importlib
import json
import os
import tempfile
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..contract import Contract
from ..operators.encode import DOC, FIELDS, KEY, doc_column, fields_column

FORMAT = "onlineview-kv"
#: Fields to remove from a stored hash, and the second at which a record expires (both optional columns).
STALE, DEADLINE = "stale_fields", "expires_at_s"
#: Records whose commands are flushed together.
DEFAULT_BATCH = 500


def load(spec: str):
    """The object that ``module:attribute`` names."""
    mod, _, attr = spec.partition(":")
    return getattr(importlib.import_module(mod), attr)


# -------------------------------------------------------------- data source
@dataclass
class KVCommit(WriterCommitMessage):
    records: int
    commands: int
    flushes: int


class KVWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.client_spec = options["client"]
        self.url = options["url"]
        self.batch = int(options.get("batch_size", DEFAULT_BATCH))
        self.ttl = int(options.get("ttl_seconds", 0))
        self.target = options.get("target", "hash")
        self.summary = options["summary"]

    def commands(self, rows):
        """Commands of some (key, payload, stale fields, deadline) records; one without payload is a deletion."""
        out = []
        for key, value, stale, deadline in rows:
            if value is None:
                out.append(("del", key))
                continue
            out.append(("json_set", key, value) if self.target == "json" else ("hset", key, dict(value)))
            if stale:
                out.append(("hdel", key, list(stale)))
            if deadline is not None:
                out.append(("expireat", key, deadline))
            elif self.ttl > 0:
                out.append(("expire", key, self.ttl))
        return out

    def write(self, iterator):
        client = load(self.client_spec)(self.url)
        rows = []
        records = commands = flushes = 0

        def flush(n):
            nonlocal records, commands, flushes
            cmds = self.commands(rows[:n])
            client.write_batch(cmds)
            records, commands, flushes = records + n, commands + len(cmds), flushes + 1
            del rows[:n]

        try:
            for b in iterator:
                rows += zip(*(b.column(x).to_pylist() for x in (KEY, "payload", STALE, DEADLINE)))
                while len(rows) >= self.batch:
                    flush(self.batch)
            if rows:
                flush(len(rows))
        finally:
            client.close()
        return KVCommit(records, commands, flushes)

    def commit(self, messages):
        # runs in a helper process of the driver; the file hands the totals to the driver itself
        done = [m for m in messages if m]
        with open(self.summary, "w") as fh:
            json.dump({"records": sum(m.records for m in done), "commands": sum(m.commands for m in done),
                       "flushes": sum(m.flushes for m in done), "tasks": len(done)}, fh)


class KVDataSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        kind = "string" if self.options.get("target") == "json" else "map<string,string>"
        return f"{KEY} string, payload {kind}, {STALE} array<string>, {DEADLINE} long"

    def writer(self, schema, overwrite):
        return KVWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(KVDataSource)


# ------------------------------------------------------------------- write
def payload(df: DataFrame, c: Contract, target: str = "hash", mode: str = "contract", keep_metadata: bool = False,
            exact_floats: bool = True) -> Column:
    """The one column that a target needs: the JSON document, or the hash fields."""
    if target == "json":
        return doc_column(df, c, mode, keep_metadata).alias(DOC)
    return fields_column(df, c, mode, keep_metadata, exact_floats).alias(FIELDS)


def deadline(c: Contract) -> Column:
    """Second at which a record expires, counted from its event time."""
    return (F.unix_seconds(F.col(c.event_time_column).cast("timestamp")) + F.lit(c.ttl_seconds)).alias(DEADLINE)


def replacement(recs: DataFrame, stored: DataFrame, target: str = "hash") -> tuple[DataFrame, DataFrame]:
    """Records and deletions that turn what is stored into exactly ``recs``: stale keys go, and stale fields of hashes that stay."""
    gone = stored.select(KEY).join(recs.select(KEY), KEY, "left_anti")
    if target == "json":
        return recs, gone
    old = stored.select(KEY, F.map_keys(FIELDS).alias("__old"))
    both = recs.join(old, KEY, "left").withColumn(STALE, F.array_except("__old", F.map_keys(FIELDS)))
    return both.drop("__old"), gone


def create_index(url: str, c: Contract, *, client: str) -> str | None:
    """Have the store index a group's hashes by prefix, if its client can: the name of the index, else None."""
    opened = load(client)(url)
    try:
        if not hasattr(opened, "create_index"):
            return None
        name = f"idx:{c.key_prefix}"
        kinds = dict(c.features) | {c.entity_column: "TAG"}
        opened.create_index(name, f"{c.key_prefix}:", kinds)
        return name
    finally:
        opened.close()


def write_kv(spark: SparkSession, recs: DataFrame, url: str, *, client: str, deletes: DataFrame | None = None,
             batch_size: int = DEFAULT_BATCH, ttl_seconds: int = 0, target: str = "hash",
             partitions: int | None = None) -> dict:
    """Write (key, fields) or (key, doc) records, plus optional key deletions, to a key-value store.

    Records may carry the columns ``STALE`` (fields to remove) and ``DEADLINE`` (instead of ``ttl_seconds`` from the write).
    ``partitions`` fixes the number of write tasks = concurrent connections
    (hash of key, so each key is written by exactly one task). Returns the records,
    commands, flushes and tasks of the successful attempts.
    """
    register(spark)
    value, kind = (DOC, "string") if target == "json" else (FIELDS, "map<string,string>")
    extra = {STALE: "array<string>", DEADLINE: "long"}
    out = recs.select(F.col(KEY), F.col(value).alias("payload"),
                      *[(F.col(x) if x in recs.columns else F.lit(None)).cast(t).alias(x) for x, t in extra.items()])
    if deletes is not None:
        out = out.unionByName(deletes.select(F.col(KEY), F.lit(None).cast(kind).alias("payload"), *[F.lit(None).cast(t).alias(x) for x, t in extra.items()]))
    if partitions:
        out = out.repartition(partitions, KEY)
    handle, summary = tempfile.mkstemp(prefix="onlineview-kv-", suffix=".json")
    os.close(handle)
    try:
        (out.write.format(FORMAT).mode("append")
            .option("url", url).option("client", client).option("batch_size", str(batch_size))
            .option("ttl_seconds", str(ttl_seconds)).option("target", target).option("summary", summary).save())
        with open(summary) as fh:
            return json.load(fh)
    finally:
        os.unlink(summary)
