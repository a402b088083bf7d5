"""Every registered query against its DuckDB twin (row count, column names, order-insensitive values).

This mirrors the driver's correctness gate on the smallest scale so it runs in the normal test suite;
``tools/check_oracle.py`` runs the same comparison at any scale.
"""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as E
from orderstar.plans import registry
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    # No registered query is left without a SQL twin.
    assert sorted(QUERIES) == sorted(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "customer_id"
    assert df.count() >= 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[key])
    o_cols, o_rows = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    hs, ls = digest(s_cols, s_rows)
    ho, lo = digest(o_cols, o_rows)
    assert hs == ho, (sorted(set(ls) - set(lo))[:3], sorted(set(lo) - set(ls))[:3])
