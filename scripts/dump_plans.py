"""Write the physical plans of the headline queries to PLANS.md (sf0.01)."""

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from onlineview.plans import catalog  # noqa: E402
from onlineview.session import local_session  # noqa: E402

NAMES = ["latest_events", "latest_by_max_by", "snapshot_counts", "changes_since", "hash_fields",
         "tag_aggregate", "point_get", "batch_get", "reconcile_report", "as_of_on_hour_layout"]


def as_of_on_hour_layout(spark, sf):
    from onlineview.operators import snapshot as S
    from onlineview.plans import roles as R
    from onlineview.session import scratch_path
    from onlineview.sinks import export as EX
    path = scratch_path(spark, "hist")
    EX.append_history(R.events(spark, sf), path, "ts")
    return S.snapshot_as_of(R.read_history(spark, path), R.EVENTS, catalog.AS_OF)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = ["# Physical plans of headline queries", "",
           "Generated by `scripts/dump_plans.py` (sf0.01, local[8], AQE on; plans before runtime re-planning).", "",
           "What to look for:", "",
           "* snapshot queries: `WindowGroupLimit ... Partial` *below* the only `Exchange hashpartitioning(entity)`:"
           " each map task ships at most one row per entity (hot entities cost one row per task).",
           "* `latest_by_max_by` / `changes_since`: partial aggregate below the exchange (map-side combine);"
           " `changes_since` replaces two window shuffles + a join with one aggregate.",
           "* `snapshot_counts`: one global aggregate over a union, no join.",
           "* `batch_get`: one left join on the key, no hint; AQE decides from run-time sizes.",
           "* `tag_aggregate`: the scan reads typed feature columns, not the field map.",
           "* `point_get`: the scan lists one bucket folder.",
           "* `reconcile_report`: one full outer join on `key`.",
           "* `as_of_on_hour_layout`: `PartitionFilters` on year/month/day/hour plus `ts` in `PushedFilters`.",
           ""]
    for name in NAMES:
        fn = catalog.QUERIES.get(name) or globals()[name]
        df = fn(spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="simple")
        out += [f"## {name}", "", "```", buf.getvalue().strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main()
