"""Scope matrix against the oracle: every analysis with every single scope
key (honoured or ignored), on sf0.001."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest
from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from starlens import oracle  # noqa: E402
from starlens.operators.analyses import ANALYSES  # noqa: E402
from starlens.sources.star import Star  # noqa: E402

# One fixture value per scope key (FIXTURES.md).
VALUES = {
    "region": entry.REGION, "city": entry.CITY, "category": entry.CATEGORY, "courier_name": entry.COURIER,
    "return_reason": entry.RETURN_REASON, "device_type": entry.DEVICE, "payment_method": entry.METHOD,
    "payment_status": entry.STATUS,
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("analysis", sorted(ANALYSES))
def test_each_key(spark, con, analysis):
    star = Star.from_fixtures(spark, SF_SMALL)
    for key, value in VALUES.items():
        scope = {key: value}
        df = ANALYSES[analysis].run(star, scope)
        s_rows = [tuple(r) for r in df.collect()]
        cur = con.execute(oracle.breakdown_sql(analysis, scope))
        o_cols = [c[0] for c in cur.description]
        o_rows = cur.fetchall()
        assert len(s_rows) == len(o_rows), (analysis, key)
        assert digest(df.columns, s_rows) == digest(o_cols, o_rows), (analysis, key)
