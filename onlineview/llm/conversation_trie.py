"""Conversation prefix trie: who shares how much of a conversation, totalled over every subtree.

Each distinct sequence of first d turns (role, text) is a node. A conversation's prefixes are
named by running combinations of 64-bit hashes, two of them, of each turn's SHA-256 and place,
so nodes are found by one aggregation; no conversation is gathered in one row. Numbers and
running hashes come from range sorts whose parts are streamed; a conversation with a third of
all turns is spread over parts and continued from one to the next.

Subtree totals come from parallel tree contraction. Each round rakes all leaves into their parents
and compresses unary nodes into their only children where a node's random rank is a local
maximum of its chain, so a chain shrinks by a third a round and the rounds grow with the logarithm of the
trie, however deep it is. All joins of a round are on the node itself, which is unique on both sides,
so a parent with very many children is no hot key. Re-expansion goes back through the rounds and gives
each compressed node its child's total plus what the two had gathered by then.

Defined results: rows without a conv_id are left out; a null role or text is empty; turns are
ordered by turn (null first), then role, then text, so ties are settled by content and repeated
rows are turns of their own; very long texts are read whole, by hash and length; other
columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import staged
from .text import set_batches

#: A conversation starts with turns of the one whose id is the next lower multiple of POOL.
POOL = 100
#: It takes crc32(conv_id) modulo HEADS of them.
HEADS = 6
#: Characters of a text that help to place it in a range sort; ties within them are sorted whole.
ROUTE_CHARS = 32
#: Ids a chunk of an end list holds at most.
CHUNK_IDS = 1 << 16
#: Parents with more than one in HOT_SHARE of all nodes as children are joined apart; there are fewer than that many.
HOT_SHARE = 1000


# ------------------------------------------------------------------ running values over sorted parts
def _runs(conv: np.ndarray) -> np.ndarray:
    """For each row the index at which its run of equal ids starts."""
    first = np.ones(len(conv), bool)
    first[1:] = conv[1:] != conv[:-1]
    return np.maximum.accumulate(np.where(first, np.arange(len(conv)), 0))


def _numbered(batches):
    """conv_id, digest, cp, part and k: the row's number within its conversation and part."""
    part, last, count = TaskContext.get().partitionId(), None, 0
    for b in batches:
        conv = b.column(0).to_numpy()
        if not len(conv):
            continue
        start = _runs(conv)
        k = np.arange(len(conv)) - start
        if conv[0] == last:
            k[start == 0] += count
        last, count = conv[-1], int(k[-1]) + 1
        yield pa.RecordBatch.from_pydict({"conv_id": b.column(0), "digest": b.column(1), "cp": b.column(2),
                                          "part": pa.array(np.full(len(conv), part, np.int32)), "k": pa.array(k)})


def _combined(batches):
    """conv_id, depth, len, cp, ta, tb, part and the running combination xa, xb of ta and tb within part and conversation."""
    part, last, carry = TaskContext.get().partitionId(), None, None
    for b in batches:
        conv = b.column(0).to_numpy()
        if not len(conv):
            continue
        start, out = _runs(conv), {}
        for i, name in ((4, "xa"), (5, "xb")):
            own = b.column(i).to_numpy()
            run = np.bitwise_xor.accumulate(own)
            run ^= run[start] ^ own[start]
            if conv[0] == last:
                run[start == 0] ^= carry[name]
            out[name] = run
        last, carry = conv[-1], {n: v[-1] for n, v in out.items()}
        yield pa.RecordBatch.from_pydict({n: b.column(i) for i, n in enumerate(("conv_id", "depth", "len", "cp", "ta", "tb"))}
                                         | {"part": pa.array(np.full(len(conv), part, np.int32))} | {n: pa.array(v) for n, v in out.items()})


def _carried(sums: DataFrame, what: dict[str, Column]) -> DataFrame:
    """part, conv_id and what earlier parts hold of the conversation: at most one row for each part, its first conversation."""
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy("part"))
    return (sums.select("part", "conv_id", nth.alias("nth"), *[c.over(earlier).alias(n) for n, c in what.items()])
            .filter("nth > 1").drop("nth"))


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, digest, cp, idx from 1) for every turn, and (conv_id, n) for every conversation."""
    set_batches(conversations.sparkSession)
    role, text = (F.coalesce(F.col(n).cast("string"), F.lit("")) for n in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).filter("conv_id IS NOT NULL")
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    rows = rows.select("*", F.substring("text", 1, ROUTE_CHARS).alias("route"), digest.alias("digest"), F.char_length("text").cast("long").alias("cp"))
    # Spark's ascending order puts nulls first; the route is a prefix of the text, so the order is that of whole texts
    placed = (rows.repartitionByRange("conv_id", "turn", "role", "route").sortWithinPartitions("conv_id", "turn", "role", "text")
              .select("conv_id", "digest", "cp").mapInArrow(_numbered, "conv_id long, digest string, cp long, part int, k long"))
    placed = staged(placed, "trie-turns")
    sums = staged(placed.groupBy("part", "conv_id").agg((F.max("k") + 1).alias("n")), "trie-counts")
    # at most one row for each part
    before = F.broadcast(_carried(sums, {"before": F.sum("n")}))
    turns = (placed.join(before, ["part", "conv_id"], "left")
             .select("conv_id", "digest", "cp", (F.col("k") + F.coalesce("before", F.lit(0)) + 1).alias("idx")))
    return turns, sums.groupBy("conv_id").agg(F.sum("n").alias("n"))


def rebuilt(conversations: DataFrame, pool: int = POOL, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth from 1, len, digest, cp) and ids (conv_id, len) of the rebuilt conversations.

    A conversation starts with the first h turns of its pool's conversation and goes on with its own turns after its first h.
    """
    turns, sizes = ordered_turns(conversations)
    take = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    own = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % pool).alias("base"), take.alias("h"))
    # a pool's conversation has at most ``pool`` conversations, so no key here is hot
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = own.join(base, "base", "left").withColumn("head", F.least("h", F.coalesce("n_base", F.lit(0))))
    plan = staged(plan.select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "trie-plan")
    tail = (turns.filter(F.col("idx") > take).join(plan.select("conv_id", "h", "head", "len"), "conv_id")
            .select("conv_id", (F.col("head") + F.col("idx") - F.col("h")).alias("depth"), "len", "digest", "cp"))
    lead = turns.filter((F.col("conv_id") % pool == 0) & (F.col("idx") < heads)).select(F.col("conv_id").alias("base"), "idx", "digest", "cp")
    head = (plan.filter("head > 0").join(lead, "base").filter(F.col("idx") <= F.col("h"))
            .select("conv_id", F.col("idx").alias("depth"), "len", "digest", "cp"))
    return tail.unionByName(head), plan.select("conv_id", "len")


def members(turns: DataFrame) -> DataFrame:
    """conv_id, depth, len, cp and the names (a, b) of each prefix and (pa, pb) of the one before it."""
    tag = lambda salt: F.xxhash64(F.lit(salt), "depth", "digest")
    rows = turns.select("conv_id", "depth", "len", "cp", tag(1).alias("ta"), tag(2).alias("tb"))
    schema = "conv_id long, depth long, len long, cp long, ta long, tb long, part int, xa long, xb long"
    placed = staged(rows.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth").mapInArrow(_combined, schema), "trie-prefixes")
    sums = placed.groupBy("part", "conv_id").agg(F.bit_xor("ta").alias("sa"), F.bit_xor("tb").alias("sb"))
    # at most one row for each part
    before = F.broadcast(_carried(sums, {"ca": F.bit_xor("sa"), "cb": F.bit_xor("sb")}))
    full = placed.join(before, ["part", "conv_id"], "left")
    a, b = (F.col(x).bitwiseXOR(F.coalesce(c, F.lit(0))) for x, c in (("xa", "ca"), ("xb", "cb")))
    return full.select("conv_id", "depth", "len", "cp", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("ta")).alias("pa"), b.bitwiseXOR(F.col("tb")).alias("pb"))


# ------------------------------------------------------------------ tree contraction
def _rank(round_no: int, a: str, b: str) -> Column:
    return F.xxhash64(F.lit(round_no), a, b)


def _round(live: DataFrame, number: int) -> DataFrame:
    """Rake the leaves of ``live`` and compress unary nodes: what is left, with a record on each node that took in its parent."""
    leaf = F.col("kids") == 0
    got = (live.filter("pa IS NOT NULL").groupBy("pa", "pb")
           .agg(F.coalesce(F.sum(F.when(leaf, F.col("saved") + F.col("up_saved"))), F.lit(0)).alias("g_saved"),
                F.coalesce(F.sum(F.when(leaf, F.col("leaves") + F.col("up_leaves"))), F.lit(0)).alias("g_leaves"),
                F.count(F.when(~leaf, 1)).alias("left"), F.min(F.when(~leaf, F.struct("a", "b"))).alias("only"))
           .withColumnsRenamed({"pa": "a", "pb": "b"}))
    raked = (live.filter(~leaf).join(got, ["a", "b"])  # an inner node has a child, so nothing is lost
             .select("a", "b", "pa", "pb", F.col("left").alias("kids"), (F.col("saved") + F.col("g_saved")).alias("saved"),
                     (F.col("leaves") + F.col("g_leaves")).alias("leaves"), "up_saved", "up_leaves", "only"))
    mine = _rank(number, "a", "b")
    going = ((F.col("kids") == 1) & (mine > _rank(number, "only.a", "only.b")) & (F.col("pa").isNull() | (mine > _rank(number, "pa", "pb"))))
    raked = raked.withColumn("going", going)
    news = raked.filter("going").select(
        F.col("only.a").alias("a"), F.col("only.b").alias("b"), F.struct("a", "b", "pa", "pb", "saved", "leaves", "up_saved", "up_leaves").alias("v"))
    x = raked.filter(~F.col("going")).join(news, ["a", "b"], "left")
    took = F.col("v").isNotNull()
    more = lambda n: F.col(f"up_{n}") + F.coalesce(F.col(f"v.{n}") + F.col(f"v.up_{n}"), F.lit(0))
    return x.select(
        "a", "b", F.when(took, F.col("v.pa")).otherwise(F.col("pa")).alias("pa"), F.when(took, F.col("v.pb")).otherwise(F.col("pb")).alias("pb"),
        "kids", "saved", "leaves", more("saved").alias("up_saved"), more("leaves").alias("up_leaves"),
        F.col("v.a").alias("va"), F.col("v.b").alias("vb"),
        (F.col("v.saved") + F.col("up_saved")).alias("add_saved"), (F.col("v.leaves") + F.col("up_leaves")).alias("add_leaves"))


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """a, b, saved, leaves summed over the subtree of every node.

    ``nodes`` has a, b, pa, pb (null: no parent), kids, saved and leaves of each node itself.
    """
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    live = nodes.select("a", "b", "pa", "pb", "kids", "saved", "leaves", zero.alias("up_saved"), zero.alias("up_leaves"),
                        none.alias("va"), none.alias("vb"), none.alias("add_saved"), none.alias("add_leaves"))
    rounds = [live]
    while not rounds[-1].filter("kids > 0").isEmpty():
        rounds.append(staged(_round(rounds[-1], len(rounds)), "trie-round"))
    raked = lambda r: r.filter("kids = 0").select("a", "b", "saved", "leaves")
    known = raked(rounds[-1])
    for at in range(len(rounds) - 1, 0, -1):  # every node left after a round is known before that round is undone
        undone = (rounds[at].filter("va IS NOT NULL").select("va", "vb", "a", "b", "add_saved", "add_leaves").join(known, ["a", "b"])
                  .select(F.col("va").alias("a"), F.col("vb").alias("b"), (F.col("saved") + F.col("add_saved")).alias("saved"),
                          (F.col("leaves") + F.col("add_leaves")).alias("leaves")))
        known = known.unionByName(staged(undone, "trie-undone")).unionByName(raked(rounds[at - 1]))
    return known


# ------------------------------------------------------------------ ends
def _id_chunks(batches):
    """a, b, first id and comma-joined ids of each run of rows of one node, in chunks of bounded size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, conv = (batch.column(i).to_numpy() for i in range(3))
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        cuts = np.union1d(np.append(np.flatnonzero(new), len(a)), np.arange(0, len(a), CHUNK_IDS))
        text = [",".join(map(str, conv[i:j].tolist())) for i, j in zip(cuts[:-1], cuts[1:])]
        at = cuts[:-1]
        yield pa.RecordBatch.from_pydict({"a": pa.array(a[at]), "b": pa.array(b[at]), "first": pa.array(conv[at]), "ids": pa.array(text, pa.string())})


def _hashed(batches):
    """a, b, ends_sha256 of chunks sorted by node and first id, one running hash at a time."""
    key, state = None, None
    for batch in batches:
        out = []
        for a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            if (a, b) != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (a, b), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if out:
            yield _rows(out)
    if key is not None:
        yield _rows([(*key, state.hexdigest())])


def _rows(out: list) -> pa.RecordBatch:
    a, b, h = zip(*out)
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "ends_sha256": pa.array(h, pa.string())})


def end_hashes(ends: DataFrame) -> DataFrame:
    """a, b and the SHA-256 of the ascending conv_ids that end at a node.

    A hash is one sequence by nature, so the ids of a node that very many conversations share are joined
    to chunks where they were sorted, and only whole chunks are streamed through its hash.
    """
    chunked = ends.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id").mapInArrow(_id_chunks, "a long, b long, first long, ids string")
    return chunked.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_hashed, "a long, b long, ends_sha256 string")


# ------------------------------------------------------------------ the operator
def _with_parent(nodes: DataFrame) -> DataFrame:
    """``nodes`` with parent_conv_id. Children of a parent with a large share of all nodes are joined by broadcast."""
    total = nodes.count()
    parents = nodes.filter("kids > 0").select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"), "kids")
    # children add up to fewer than ``total``, so there are less than HOT_SHARE such parents
    hot = F.broadcast(parents.filter(F.col("kids") * HOT_SHARE > total).drop("kids"))
    cold = parents.filter(F.col("kids") * HOT_SHARE <= total).drop("kids")
    apart = nodes.join(hot, ["pa", "pb"])
    rest = nodes.join(hot, ["pa", "pb"], "left_anti").join(cold, ["pa", "pb"], "left")
    return apart.unionByName(rest)


def trie(conversations: DataFrame, pool: int = POOL, heads: int = HEADS) -> DataFrame:
    """One row per node: its names a, b and those of its parent, conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256."""
    turns, ids = rebuilt(conversations, pool, heads)
    prefixes = members(turns)
    found = prefixes.groupBy("a", "b").agg(
        F.max("depth").alias("depth"), F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.max("cp").alias("cp"),
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    # the root, named (0, 0), holds every conversation and stays out of the contraction; so it is no hot key there
    kids = found.groupBy("pa", "pb").agg(F.count(F.lit(1)).alias("kids")).withColumnsRenamed({"pa": "a", "pb": "b"})
    nodes = staged(found.join(kids, ["a", "b"], "left").withColumn("kids", F.coalesce("kids", F.lit(0))), "trie-nodes")
    top = (F.col("pa") == 0) & (F.col("pb") == 0)
    totals = subtree_totals(nodes.select(
        "a", "b", F.when(~top, F.col("pa")).alias("pa"), F.when(~top, F.col("pb")).alias("pb"), "kids",
        ((F.col("n_convs") - 1) * F.col("cp")).alias("saved"), F.when(F.col("kids") == 0, 1).otherwise(0).cast("long").alias("leaves")))
    sums = nodes.agg(F.count(F.when(top, 1)).alias("kids"), F.coalesce(F.sum((F.col("n_convs") - 1) * F.col("cp")), F.lit(0)).alias("saved"),
                     F.count(F.when(F.col("kids") == 0, 1)).alias("leaves"))
    first = ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    root = first.join(F.broadcast(sums), F.lit(True)).select(  # one row each
        zero.alias("a"), zero.alias("b"), zero.alias("depth"), none.alias("pa"), none.alias("pb"), zero.alias("cp"), "n_convs", "conv_id", "kids",
        "saved", F.when(F.col("kids") == 0, F.lit(1)).otherwise(F.col("leaves")).cast("long").alias("leaves"))
    linked = _with_parent(nodes.unionByName(root.drop("saved", "leaves")))
    ends = (prefixes.filter("depth = len").select("a", "b", "conv_id")
            .unionByName(ids.filter("len = 0").select(zero.alias("a"), zero.alias("b"), "conv_id")))
    return (linked.join(totals.unionByName(root.select("a", "b", "saved", "leaves")), ["a", "b"])
            .join(end_hashes(ends), ["a", "b"], "left")
            .select("a", "b", "pa", "pb", "conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"),
                    F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
