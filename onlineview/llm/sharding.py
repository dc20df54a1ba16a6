"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns the ring positions up to its virtual nodes. A document's position is a
hash of its text, so equal texts fall side by side. No shard takes more rows than its
capacity; keys that overflow a full shard continue clockwise to the next shard that is
not full. With capacities that add up to the row count, shard sizes differ by at most
one row, and a document moves from its home only if that shard is full.

Only counts per ring arc (shards times virtual nodes) reach the driver. Which rows
overflow is decided by their rank on the ring, found by one range sort of thin rows, so
a group of copies of any size is split over tasks and, where a shard is full, over shards.

Defined results: a null text has size 1 and the checksum of the empty text; repeated
rows get slots of their own; null ids are placed like others; other columns are never
read; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import staged

SHARDS = 8
VIRTUAL_NODES = 64


def ring(shards: int = SHARDS, nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, in ring order; positions are signed 64-bit."""
    at = lambda s, v: int.from_bytes(hashlib.sha256(f"shard {s} node {v}".encode()).digest()[:8], "big", signed=True)
    return sorted((at(s, v), s) for s in range(shards) for v in range(nodes))


def clockwise(nodes: list[tuple[int, int]], arc: int) -> list[int]:
    """Shards in the order in which a key of this arc meets them (arc k ends at node k; the last wraps to node 0)."""
    return list(dict.fromkeys(nodes[(arc + k) % len(nodes)][1] for k in range(len(nodes))))


def plan(nodes: list[tuple[int, int]], counts: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """(first rank, one past the last, shard, first slot): where each run of rows by ring rank goes.

    ``counts`` holds the rows of each arc, in ring order. In rounds, every arc offers the rows it
    has left to its next shard clockwise; a shard takes offers in ring order up to its capacity.
    """
    total = sum(counts)
    # the shards with one row more are those with the most keys of their own
    home = [0] * shards
    for k, n in enumerate(counts):
        home[nodes[k % len(nodes)][1]] += n
    room = [total // shards] * shards
    for s in sorted(range(shards), key=lambda s: (-home[s], s))[: total % shards]:
        room[s] += 1
    start = [sum(counts[:k]) for k in range(len(counts))]
    left, ways = list(counts), [clockwise(nodes, k) for k in range(len(counts))]
    runs, filled = [], [0] * shards
    for step in range(shards):
        for k in range(len(counts)):
            s = ways[k][step]
            take = min(left[k], room[s])
            if take:
                a = start[k] + counts[k] - left[k]
                runs.append((a, a + take, s, filled[s]))
                left[k], room[s], filled[s] = left[k] - take, room[s] - take, filled[s] + take
    return sorted(runs)


def _arc(position: Column, nodes: list[tuple[int, int]]) -> Column:
    """Index of the first node at or after the position; the arc past the last node has the index len(nodes)."""
    at = F.array(*[F.lit(p) for p, _ in nodes])
    steps = F.array(*[F.lit(1 << k) for k in range(len(nodes).bit_length() - 1, -1, -1)])

    def halve(out: Column, step: Column) -> Column:  # binary search: out nodes are known to lie before the position
        probe = out + step
        before = F.element_at(at, F.least(probe, F.lit(len(nodes)))) < position
        return F.when((probe <= len(nodes)) & before, probe).otherwise(out)

    return F.aggregate(steps, F.lit(0), halve)


def ranked(docs: DataFrame, nodes: list[tuple[int, int]]) -> DataFrame:
    """doc_id, size, text_crc32, arc, part, row: rows in ring order within parts that follow each other on the ring."""
    text = F.col("text").cast("string")
    thin = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("position"))
    order = ["position", "doc_id", "text_crc32", "size"]  # equal in all of these: interchangeable rows
    return staged(thin.repartitionByRange(*order).sortWithinPartitions(*order)
                  .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row")), "shard-ring")


def shard(docs: DataFrame, shards: int = SHARDS, nodes: int = VIRTUAL_NODES) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, home (the shard a key would go to if it were not full) for every row."""
    circle = ring(shards, nodes)
    rows = ranked(docs, circle)
    parts = sorted((r.part, r.n) for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    before, first = 0, {}
    for part, n in parts:
        first[part], before = before, before + n
    counts = [0] * (len(circle) + 1)
    placed = rows.withColumn("arc", _arc(F.col("position"), circle))
    for r in placed.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.arc] = r.n
    runs = plan(circle, counts, shards)
    starts = [r[0] for r in runs]
    # rows of one part lie in few runs; both tables are bounded by parts plus runs and are joined by rank
    cuts = []
    for part, n in parts:
        a, b = first[part], first[part] + n
        for k in range(bisect.bisect_right(starts, a) - 1, len(runs)):
            lo, hi, s, slot = runs[k]
            if lo >= b:
                break
            cuts.append((part, max(lo, a) - a, min(hi, b) - a, s, slot + max(lo, a) - lo))
    spark = docs.sparkSession
    table = spark.createDataFrame(cuts, "part int, lo long, hi long, shard int, slot0 long")
    homes = F.array(*[F.lit(s) for _, s in circle], F.lit(circle[0][1]))
    return (placed.join(F.broadcast(table), "part").filter((F.col("row") >= F.col("lo")) & (F.col("row") < F.col("hi")))
            .select("doc_id", "size", "text_crc32", "shard", (F.col("slot0") + F.col("row") - F.col("lo")).alias("slot"),
                    F.element_at(homes, F.col("arc").cast("int") + 1).alias("home")))
