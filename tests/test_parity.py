"""Oracle parity: every registered query against its DuckDB SQL on sf0.001
(the driver runs the same comparison on sf0.01)."""

from __future__ import annotations

import os
import re
import sys

import duckdb
import pytest
from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

QUERIES = entry.queries()
SQL = entry.oracle_sql()


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
    # Training-data queries without a SQL form, where registered, have brute-force tests of their own.
    assert set(SQL) <= set(QUERIES)
    assert all(re.match(r"op\d+_|pipeline$", name) for name in set(QUERIES) - set(SQL))


@pytest.mark.parametrize("name", sorted(SQL))
def test_parity(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows) == digest(o_cols, o_rows)


def test_entry(spark):
    df = entry.entry(spark)
    out = df.collect()
    assert df.columns == ["courier_name", "total_shipments", "failed", "failure_rate_pct", "avg", "severity", "type"]
    assert len(out) == 4
