"""Versioned feature-history generator over a real entity table.

Every entity of the input gets 1-3 versions in distinct hours of a 3-hour
span; a hash-chosen share of entities additionally gets a tombstone that is
always its newest version (the last ten minutes of the last hour; live versions
use the minutes before). All randomness is an md5 of (salt, entity, version, field), so
the output does not depend on partitioning, task order or retries, and the same
values can be recomputed in plain SQL.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import Contract

# Fixed values of the generated schema (feature names, segments, ranges).
SEGMENTS = ["retail", "premium", "private", "digital"]
HOURS = 3
DEFAULT_BASE = datetime(2025, 3, 10, 6, 0, 0)
LIVE_MINUTES = 50

GENERATED_CONTRACT = Contract.from_dict({
    "feature_group": "customer-features",
    "entity_column": "customer_id",
    "event_time_column": "event_time",
    "write_time_column": "write_time",
    "deleted_column": "is_deleted",
    "key_prefix": "fs:customer-features",
    "ttl_seconds": 0,
    "features": {
        "fraud_score": "NUMERIC", "credit_score": "NUMERIC", "avg_ticket_30d": "NUMERIC",
        "tx_count_24h": "NUMERIC", "device_trust": "NUMERIC", "segment": "TAG", "is_pep": "TAG",
    },
})


def md5_unit(*parts: Column) -> Column:
    """Uniform [0,1) from the first 32 bits of md5(concat(parts))."""
    h = F.conv(F.substring(F.md5(F.concat(*[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("long")
    return h / F.lit(4294967296.0)


def md5_int(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat(*[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("long")


def entity_ids(entities: DataFrame, id_column: str) -> DataFrame:
    """``C000042``-style ids from an integer key column."""
    return entities.select(F.format_string("C%06d", F.col(id_column)).alias("customer_id"))


def _smallest(ids: DataFrame, draw: Column, cid: Column, n: int) -> Column:
    """Condition that holds for the ``n`` ids with the smallest (draw, id), found by counting.

    Draws are 32-bit numbers. Two passes count them by their upper and lower half (2^16 counts each at most); only ids
    of one and the same draw are compared by name. Nothing is sorted or limited.
    """
    if n <= 0:
        return F.lit(False)
    before, upper = 0, None
    for half in (F.floor(draw / 65536), F.pmod(draw, F.lit(65536))):
        rows = ids if upper is None else ids.filter(F.floor(draw / 65536) == upper)
        for r in sorted(rows.groupBy(half.cast("long").alias("h")).agg(F.count(F.lit(1)).alias("n")).collect()):
            if before + r["n"] >= n:
                break
            before += r["n"]
        else:
            return F.lit(True)  # there are no more than n ids
        upper, last = (r["h"], 0) if upper is None else (upper, upper * 65536 + r["h"])
    tied = sorted(x[0] for x in ids.filter(draw == last).select(cid).collect())  # one in 2^32 of the ids
    return (draw < last) | ((draw == last) & (cid <= tied[n - before - 1]))


def generate_history(entities: DataFrame, id_column: str, *, tombstone_share: float = 0.03,
                     tombstones: int | None = None, salt: str = "42", base: datetime = DEFAULT_BASE) -> DataFrame:
    """History rows for every entity of ``entities``.

    A share of the entities is tombstoned, or exactly ``tombstones`` of them: those with the smallest hashes.
    The ids alone are shuffled, so that the hashing is spread over tasks however few files the entities lie in.
    """
    s = F.lit(salt)
    ids = entity_ids(entities, id_column)
    cid = F.col("customer_id")
    n_versions = (F.pmod(md5_int(s, F.lit("v"), cid), F.lit(3)) + 1).cast("int")
    draw = md5_unit(s, F.lit("d"), cid)
    if tombstones is None:
        tomb = draw < F.lit(tombstone_share)
    else:
        tomb = _smallest(ids.distinct(), md5_int(s, F.lit("d"), cid), cid, tombstones)
    # hours without replacement: rotate [0,1,2] by a hash and keep the first n
    rot = F.pmod(md5_int(s, F.lit("h"), cid), F.lit(3)).cast("int")
    # a number, as AQE would merge ids, which are small, into few tasks
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_entity = ids.repartition(tasks).select(cid, n_versions.alias("n"), tomb.alias("tomb"), rot.alias("rot"))
    live = (per_entity
            .select(cid, "tomb", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("v"), "rot")
            .withColumn("hour_idx", F.pmod(F.col("v") + F.col("rot"), F.lit(HOURS)))
            .withColumn("is_deleted", F.lit(False)))
    dead = (per_entity.filter("tomb")
            .select(cid, "tomb", F.lit(HOURS).alias("v"), F.lit(0).alias("rot"))
            .withColumn("hour_idx", F.lit(HOURS - 1))
            .withColumn("is_deleted", F.lit(True)))
    rows = live.unionByName(dead)
    v = F.col("v")

    def u(name: str) -> Column:
        return md5_unit(s, cid, v, F.lit(name))

    minute = F.when(F.col("is_deleted"), LIVE_MINUTES + F.floor(u("m") * (60 - LIVE_MINUTES))).otherwise(F.floor(u("m") * LIVE_MINUTES))
    secs = F.floor(u("s") * 60)
    millis = F.floor(u("ms") * 1000)
    event = (F.lit(base.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
             + F.make_dt_interval(hours=F.col("hour_idx").cast("int"), mins=minute.cast("int"),
                                  secs=(secs + millis / 1000).cast("decimal(8,3)")))
    write = event + F.make_dt_interval(mins=(5 + F.floor(u("w") * 10)).cast("int"))
    seg = F.element_at(F.array(*[F.lit(x) for x in SEGMENTS]), (F.floor(u("seg") * 4) + 1).cast("int"))
    return rows.select(
        cid,
        F.date_format(event, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"),
        F.round(u("fraud"), 6).alias("fraud_score"),
        (300 + F.floor(u("credit") * 701)).cast("long").alias("credit_score"),
        F.round(20 + u("ticket") * 4980, 2).alias("avg_ticket_30d"),
        F.floor(u("tx") * 121).cast("long").alias("tx_count_24h"),
        F.round(u("trust"), 4).alias("device_trust"),
        seg.alias("segment"),
        (u("pep") < 0.02).alias("is_pep"),
        (event + F.make_dt_interval(secs=F.lit(1))).alias("api_invocation_time"),
        write.alias("write_time"),
        F.col("is_deleted"),
    )
