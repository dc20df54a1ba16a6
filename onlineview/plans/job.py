"""End-to-end materialization job: history -> snapshot -> online store -> verify.

Stages (one Spark application):
  1. read the contract and the history (files or a catalog table; empty = error)
  2. validate the contract against the schema (strict by default)
  3. set rows without an entity id aside (counted, never written)
  4. keep only the columns that are written or rank versions; rank once and persist the
     winners (recomputed from lineage if an executor is lost); counts come from them
  5. live snapshot = winners without tombstones
  6. encode + write (online Parquet table, or a key-value store through a client)
  7. register the typed view (the index)
  8. reconcile: count check, full diff, sampled read-back; raise on mismatch

A snapshot that is deduplicated already (another engine's export) goes through the same
stages with ``ready_snapshot=True``: no ranking and no tombstone filter.

Usage: python -m onlineview.plans.job (--source PATH | --table NAME) --contract JSON|PATH|URI
       (--online-root PATH | --kv-url URL --kv-client MODULE:FACTORY [--kv-reader MODULE:FUNCTION])
       [--mode replace|merge] ...
Exit codes: 0 verified, 1 mismatch, 2 no data.
"""

from __future__ import annotations

import argparse
import logging
import sys
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract, ContractError
from ..operators import encode as ENC
from ..operators import online as ON
from ..operators import reconcile as RC
from ..operators import snapshot as S
from ..session import DEFAULT_CONF, ensure_checkpoint_dir
from ..sinks import export as EX
from ..sinks import kv as KV
from ..sinks import online_table as OT
from ..sources.history import EmptySource, load_contract, read_history, read_table

log = logging.getLogger("onlineview.job")


@dataclass
class JobResult:
    raw_records: int
    quarantined: int
    entities: int
    tombstoned: int
    live: int
    written: int
    report: RC.Report | None
    index: str | None = None
    exported: str | None = None

    @property
    def ok(self) -> bool:
        return self.report is None or self.report.ok


def _history(spark, source, table, recursive, suffix, merge_schema) -> DataFrame:
    if (source is None) == (table is None):
        raise ValueError("give exactly one of source or table")
    if table is not None:
        hist = read_table(spark, table)
        if hist.isEmpty():
            raise EmptySource(f"table {table} is empty")
        return hist
    return read_history(spark, source, recursive=recursive, suffix=suffix, merge_schema=merge_schema, check_empty=True)


def materialize(spark: SparkSession, source: str | None, contract: Contract, *, table: str | None = None,
                online_root: str | None = None, kv_url: str | None = None, kv_client: str | None = None,
                kv_reader: str | None = None, mode: str = "replace", strict: bool = True, sample: int = 25,
                sample_salt: str = "", lenient_diff: bool = False, partitions: int | None = None,
                buckets: int | None = None, batch_size: int = KV.DEFAULT_BATCH, write_mode: str = "contract",
                keep_metadata: bool = False, target: str = "hash", exact_floats: bool = True,
                ttl_anchor: str = "write", export_path: str | None = None, create_index: bool = True,
                fail_on_mismatch: bool = True, recursive: bool = False, suffix: str | None = None,
                merge_schema: bool = False, ready_snapshot: bool = False) -> JobResult:
    if (online_root is None) == (kv_url is None):
        raise ValueError("give exactly one of online_root or kv_url")
    if kv_url is not None and not kv_client:
        raise ValueError("a key-value store needs a client (module:factory)")
    if kv_url is not None and mode == "replace" and not kv_reader:
        raise ValueError("a key-value store is replaced through a reader that tells its stale keys; without one, use merge")
    ensure_checkpoint_dir(spark)
    hist = _history(spark, source, table, recursive, suffix, merge_schema)
    if ready_snapshot:  # exports carry no feature-store metadata
        contract = contract.with_(deleted_column="", write_time_column="")
    c = contract.validate(hist.schema, strict=strict)
    if table is None:
        hist = S.drop_partition_columns(hist, c)
    seen = hist.agg(F.count("*").alias("n"), F.count_if(F.col(c.entity_column).isNull()).alias("bad")).first()
    raw, bad = int(seen["n"]), int(seen["bad"])
    known = ENC.needed(hist, c, write_mode, keep_metadata) if export_path is None else hist
    known = known.filter(F.col(c.entity_column).isNotNull())
    if c.dedupe_enabled and not ready_snapshot:
        # rank the history ONCE: winners (tombstones included) feed both the
        # counts and the live snapshot; recomputed from lineage if lost
        winners = S.latest(known, c, drop_tombstones=False).persist(StorageLevel.MEMORY_AND_DISK)
        wc = S.winner_counts(winners, c).first()
        entities, tombstoned, n_live = int(wc["entities"]), int(wc["tombstoned"]), int(wc["live"])
        live = S.not_deleted(c, winners)
        snap = winners if live is None else winners.filter(live)
    else:
        if not known.groupBy(c.entity_column).count().filter("count > 1").isEmpty():
            raise ValueError("nothing is deduplicated and entity keys are not unique; refusing to write")
        winners = snap = known.persist(StorageLevel.MEMORY_AND_DISK)
        entities, tombstoned, n_live = raw - bad, 0, raw - bad
    rep = index = exported = stored = None
    try:
        if online_root:
            recs = OT.records(snap, c, mode=write_mode, keep_metadata=keep_metadata, with_doc=target == "json",
                              ttl_anchor=ttl_anchor, exact_floats=exact_floats)
            written = OT.write_online(spark, recs, online_root, c, mode=mode, buckets=buckets).written
            stored = OT.read_online(spark, online_root, c.feature_group, typed=c)
        else:
            timed = [KV.deadline(c)] if c.ttl_seconds > 0 and ttl_anchor == "event" else []
            out = snap.select(ENC.online_key(c).alias(ENC.KEY),
                              KV.payload(snap, c, target, write_mode, keep_metadata, exact_floats), *timed)
            kept = None
            if kv_reader:
                kept = KV.load(kv_reader)(spark, kv_url).filter(F.col(ENC.KEY).startswith(c.key_prefix + ":"))
            gone = None
            if mode == "replace":
                out, gone = KV.replacement(out, kept, target)
            written = KV.write_kv(spark, out, kv_url, client=kv_client, deletes=gone, ttl_seconds=c.ttl_seconds, target=target,
                                  partitions=partitions, batch_size=batch_size)["records"]
            if kv_reader:
                stored = KV.load(kv_reader)(spark, kv_url).filter(F.col(ENC.KEY).startswith(c.key_prefix + ":"))
            if create_index and target == "hash":
                index = KV.create_index(kv_url, c, client=kv_client)
        if stored is not None:
            if create_index and target == "hash":
                index = ON.register_index(spark, stored, c) if index is None else index
            if target == "json":  # compare whole documents
                as_map = lambda df: df.select(ENC.KEY, F.create_map(F.lit("doc"), F.col(ENC.DOC)).alias(ENC.FIELDS))
                expected, stored = as_map(ENC.json_docs(snap, c, write_mode, keep_metadata)), as_map(stored)
            else:
                expected = ENC.hash_fields(snap, c, write_mode, keep_metadata, exact_floats)
            rep = RC.report(expected, stored.select(ENC.KEY, ENC.FIELDS), sample=sample, strict=not lenient_diff,
                            salt=sample_salt)
        if export_path:
            exported = EX.export_snapshot(ENC.project(snap, c, "all", keep_metadata), export_path)
    finally:
        winners.unpersist()
    res = JobResult(raw, bad, entities, tombstoned, n_live, int(written), rep, index, exported)
    for line in rep.lines() if rep else ["no reader given: the store was not read back"]:
        log.info(line)
    if fail_on_mismatch and rep:
        RC.gate(rep)
    return res


def parse_args(argv):
    ap = argparse.ArgumentParser(prog="onlineview.job")
    ap.add_argument("--source", help="Parquet history")
    ap.add_argument("--table", help="catalog table as history")
    ap.add_argument("--contract", required=True, help="inline JSON, local path or any Hadoop URI")
    ap.add_argument("--online-root")
    ap.add_argument("--kv-url")
    ap.add_argument("--kv-client", help="module:factory of the key-value client")
    ap.add_argument("--kv-reader", help="module:function(spark, url) that reads the store back for verification")
    ap.add_argument("--mode", choices=["replace", "merge"], default="replace")
    ap.add_argument("--lenient", action="store_true", help="skip contract columns missing from the data")
    ap.add_argument("--lenient-diff", action="store_true", help="check only fields the snapshot has")
    ap.add_argument("--sample", type=int, default=25)
    ap.add_argument("--sample-salt", default="")
    ap.add_argument("--partitions", type=int, help="key-value write tasks = concurrent connections")
    ap.add_argument("--buckets", type=int, help="hash buckets of a new or replaced online group")
    ap.add_argument("--batch-size", type=int, default=KV.DEFAULT_BATCH, help="records per flush")
    ap.add_argument("--all-columns", action="store_true", help="write every non-metadata column")
    ap.add_argument("--keep-metadata", action="store_true")
    ap.add_argument("--target", choices=["hash", "json"], default="hash")
    ap.add_argument("--native-floats", action="store_true", help="JVM text for doubles, also where it is not shortest")
    ap.add_argument("--ttl-anchor", choices=["write", "event"], default="write")
    ap.add_argument("--export-snapshot")
    ap.add_argument("--recursive", action="store_true")
    ap.add_argument("--suffix")
    ap.add_argument("--merge-schema", action="store_true")
    ap.add_argument("--ready-snapshot", action="store_true", help="the source is deduplicated already")
    args, unknown = ap.parse_known_args(argv)
    if unknown:  # schedulers may add options of their own
        log.info("%d further arguments are not for this job", len(unknown))
    return args


def main(argv=None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = parse_args(sys.argv[1:] if argv is None else argv)
    builder = SparkSession.builder.appName("onlineview-materialize")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        res = materialize(spark, args.source, load_contract(spark, args.contract), table=args.table,
                          online_root=args.online_root, kv_url=args.kv_url, kv_client=args.kv_client,
                          kv_reader=args.kv_reader, mode=args.mode, strict=not args.lenient, sample=args.sample,
                          sample_salt=args.sample_salt, lenient_diff=args.lenient_diff, partitions=args.partitions,
                          buckets=args.buckets, batch_size=args.batch_size,
                          write_mode="all" if args.all_columns else "contract", keep_metadata=args.keep_metadata,
                          target=args.target, exact_floats=not args.native_floats, ttl_anchor=args.ttl_anchor,
                          export_path=args.export_snapshot, recursive=args.recursive, suffix=args.suffix,
                          merge_schema=args.merge_schema, ready_snapshot=args.ready_snapshot)
    except RC.ReconciliationError as e:
        log.error("the online store differs from the snapshot: %s", e)
        return 1
    except EmptySource as e:
        log.error("%s", e)
        return 2
    except ContractError as e:
        log.error("contract: %s", e)
        return 3
    log.info("%d raw records, %d set aside without an id, %d entities, %d tombstoned, %d live, %d written",
             res.raw_records, res.quarantined, res.entities, res.tombstoned, res.live, res.written)
    return 0


if __name__ == "__main__":
    sys.exit(main())
