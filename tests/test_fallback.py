"""Beyond the broadcast bound: the same results through sort-merge joins."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest
from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

NAMES = [
    "payment_failure_by_method_region_city",
    "orders_by_region_category",
    "return_rate_by_sku_category_region",
    "inventory_by_warehouse_region",
    "report_signals_region",
    "root_cause_region_courier",
    "question_scope",
]


@pytest.fixture()
def no_broadcast(spark):
    keys = ["starlens.broadcast.maxRows", "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set("starlens.broadcast.maxRows", "3")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_sort_merge_path_matches_oracle(no_broadcast, name):
    spark = no_broadcast
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
    cur = con.execute(entry.oracle_sql()[name])
    o_cols = [c[0] for c in cur.description]
    assert digest(df.columns, s_rows) == digest(o_cols, cur.fetchall())
