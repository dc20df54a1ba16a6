"""Queries of the training-data operators against their DuckDB SQL, at the scale the correctness run uses."""

import duckdb
import pytest

from onlineview.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(got.columns)
    order = lambda rows: sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x) for x in r])
    assert order(got.select(*cols).collect()) == order(want.fetchall())


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
