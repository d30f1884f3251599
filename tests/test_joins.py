"""Broadcast hints follow the current size of the dimensions."""

from __future__ import annotations

import tempfile

import pytest
from conftest import SF_SMALL, make_star

from starlens.operators.analyses import ANALYSES
from starlens.operators.rootcause import root_cause
from starlens.plans.joins import small_tables
from starlens.sources.schemas import KEYS, SCHEMAS
from starlens.sources.star import Star


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture()
def bound(spark):
    spark.conf.set("starlens.broadcast.maxRows", "100")
    yield spark
    spark.conf.unset("starlens.broadcast.maxRows")


def test_a_table_that_grows_past_the_bound_is_no_longer_hinted(bound):
    spark, root = bound, tempfile.mkdtemp(prefix="starlens-grow-")
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}")
    regions = lambda a, b: spark.range(a, b).selectExpr("cast(id as string) region_id", "'W' region_name", "'c' country")
    regions(0, 50).write.mode("append").parquet(f"{root}/dim_regions")
    star = Star.from_parquet(spark, root)
    assert "strategy=broadcast" in _plan(star.broadcast(star["dim_regions"], "dim_regions").join(star["dim_warehouses"], "region_id"))
    regions(50, 5000).write.mode("append").parquet(f"{root}/dim_regions")
    star = Star.from_parquet(spark, root)  # read again: listed and checked again
    assert "strategy=broadcast" not in _plan(star.broadcast(star["dim_regions"], "dim_regions").join(star["dim_warehouses"], "region_id"))


def test_bounds_in_rows_bytes_and_keys(bound):
    spark = bound
    rows = lambda n, k: spark.range(n).selectExpr(f"cast(id % {k} as string) region_id", "'W' region_name", "'c' country")
    tables = {"few": rows(100, 100), "many": rows(101, 101), "repeated": rows(50, 49), "none": rows(0, 1)}
    keys = dict.fromkeys(tables, KEYS["dim_regions"])
    assert small_tables(tables, keys) == {"few": True, "many": False, "repeated": False, "none": True}
    spark.conf.set("starlens.broadcast.maxBytes", "1")
    try:
        assert small_tables({"few": spark.createDataFrame([("a",)], "region_id string")}, {"few": "region_id"}) == {"few": False}
    finally:
        spark.conf.unset("starlens.broadcast.maxBytes")


def test_the_check_gathers_no_rows_into_one_task(spark):
    star = Star.from_fixtures(spark, SF_SMALL)
    star.check_dimensions()
    assert set(star._small) == {n for n in SCHEMAS if n.startswith("dim_")} and all(star._small.values())


def test_top_skus_shuffle_the_lines_once(spark):
    star = Star.from_fixtures(spark, SF_SMALL)
    plan = ANALYSES["return_rate_by_sku"].run(star, {})._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "LeftOuter" not in plan
    assert plan.count("BroadcastExchange") >= 1 and "TakeOrderedAndProject" in plan


def test_clicks_in_a_region_have_no_exchange_on_the_customer(spark):
    star = Star.from_fixtures(spark, SF_SMALL)
    for name in ("clickstream_by_device", "clickstream_funnel"):
        df = ANALYSES[name].run(star, {"region": "ASIA"}, ordered=False)
        assert "hashpartitioning(customer_id" not in df._jdf.queryExecution().executedPlan().toString()


def test_root_cause_locates_orders_before_lines(spark):
    star = Star.from_fixtures(spark, SF_SMALL)
    assert root_cause(star, {"region": "ASIA", "device_type": "mobile"}).count() > 0  # ignored key is logged


def test_money_is_rounded_after_the_sum(spark):
    nan, inf = float("nan"), float("inf")
    values = {"A": [0.004] * 1000, "B": [1.005, 2.005], "C": [nan, 1.0], "D": [inf, 1.0], "E": [inf, -inf], "F": [None, 3.0]}
    star = make_star(
        spark,
        dim_categories=[(c, c) for c in values],
        dim_skus=[(f"s{c}", c, 1.0) for c in values],
        fact_order_lines=[(f"{c}{i}", f"o{i}", f"s{c}", "w", 1, v) for c, vs in values.items() for i, v in enumerate(vs)],
    )
    got = {r.category_name: r.total_revenue for r in ANALYSES["revenue_by_category"].run(star, {}).collect()}
    assert got["A"] == 4.0 and got["B"] == 3.01 and got["D"] == inf and got["F"] == 3.0
    assert got["C"] != got["C"] and got["E"] != got["E"]  # NaN
