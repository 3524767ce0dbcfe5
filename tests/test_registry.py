"""Every registered query has its SQL, and some are compared here on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from loom import oracles, queries

SMALL = "/root/testdata/sf0.001"


def test_all_have_sql():
    assert set(queries.queries()) == set(oracles.oracle_sql())
    assert set(queries.queries()) <= set(entry.queries())


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", ["nested_levels", "neighbors_topn_ties", "coupling_close", "coupling_scores", "universal_roles", "kendall_summary", "hierarchy_tree", "neighbor_stats", "hierarchy_depths", "class_set_sizes", "rejected_documents"])
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in Path(SMALL).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.sql(oracles.oracle_sql()[name])
    got = queries.queries()[name](spark, SMALL)
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    text = lambda rows: sorted(tuple("null" if v is None or v != v else f"{float(v):.5f}" if isinstance(v, (int, float)) else str(v) for v in r) for r in rows)
    at = [want.columns.index(c) for c in cols]
    assert text(tuple(r[i] for i in at) for r in want.fetchall()) == text(tuple(r) for r in got.select(*cols).collect())
