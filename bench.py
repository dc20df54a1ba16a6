"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.
Each query is executed completely through the no-op sink (no driver collect);
queries that write an online table include that write in their time.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Each query is timed so often; the median counts.
RUNS = 3
HEADLINE = [
    "latest_events",
    "latest_orders_tiebreak",
    "latest_by_max_by",
    "snapshot_counts",
    "snapshot_changes",
    "changes_since",
    "hash_fields",
    "json_docs",
    "tag_aggregate",
    "batch_get",
    "reconcile_report",
    "incremental_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from onlineview.session import local_session, ship_package

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="onlineview-bench")
    ship_package(spark)
    from onlineview.plans import catalog, job, roles
    from onlineview.session import scratch_path

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    def median_seconds(work):
        seconds = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            work()
            seconds.append(time.perf_counter() - t0)
        return round(statistics.median(seconds), 3)

    run(catalog.latest_events(spark, sf_dir))  # warm-up (JVM, codegen caches)
    times = {}
    for name in HEADLINE:
        times[name] = median_seconds(lambda: run(catalog.QUERIES[name](spark, sf_dir)))  # noqa: B023

    # end-to-end job: history -> snapshot -> online table -> index -> reconcile gate
    src = scratch_path(spark, "bench-history")
    roles.events(spark, sf_dir).write.parquet(src)

    def materialize():
        assert job.materialize(spark, src, roles.EVENTS, online_root=scratch_path(spark, "bench-online")).ok
    times["materialize_job"] = median_seconds(materialize)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_headline_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
