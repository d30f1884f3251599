"""Deterministic star-schema views over the TPC-H-like test tables.

The analyses read fourteen star tables.  In production these are written by
the ingest streams (``starlens.streaming.ingest``); for tests and benchmarks
they are derived here, lazily, from the driver's parquet tables.  Each view
is a projection (plus a filter for returns) of one or two source tables, so
Catalyst prunes columns and pushes filters into the parquet scan of the
source table.

The mapping rules are fixed values of the fixture contract (see FIXTURES.md).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.sources.schemas import SCHEMAS


def _s(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string")


def line_key() -> Column:
    """Unique key of a lineitem row (``l_orderkey, l_linenumber`` is not unique)."""
    return F.concat_ws(
        "-",
        _s("l_orderkey"),
        _s("l_linenumber"),
        _s("l_partkey"),
        _s("l_suppkey"),
        _s(F.col("l_quantity").cast("int")),
    )


def _bucket(expr: Column, cuts: list[tuple[int, str]], last: str) -> Column:
    """``CASE WHEN expr < c1 THEN v1 WHEN expr < c2 THEN v2 ... ELSE last``."""
    out = None
    for cut, value in cuts:
        out = F.when(expr < cut, value) if out is None else out.when(expr < cut, value)
    return out.otherwise(last)


# Fixture mapping of source columns onto star columns.
FAILURE_REASON_BUCKETS = [(7, "gateway_error"), (9, "insufficient_funds")]
FAILURE_REASON_LAST = "timeout"
COURIER_BUCKETS = [(5, "COURIER_A"), (8, "COURIER_B"), (9, "COURIER_C")]
COURIER_LAST = "COURIER_D"
RETURN_REASON_UP_TO_4 = "damaged"
RETURN_REASON_BY_LINE = {5: "wrong_item", 6: "not_needed", 7: "size_issue"}
DEVICE_BUCKETS = [(6, "mobile"), (9, "desktop")]
DEVICE_LAST = "tablet"


def star_views(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """The fourteen star tables over ``sf_dir``, each a function that builds
    its view; a source table is read once, when a view first needs it."""

    @cache
    def t(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    null_s = F.lit(None).cast("string")

    views = {
        "dim_regions": lambda: t("region").select(
            _s("r_regionkey").alias("region_id"),
            F.col("r_name").alias("region_name"),
            null_s.alias("country"),
        ),
        "dim_customer_addresses": lambda: t("nation").select(
            _s("n_nationkey").alias("address_id"),
            F.col("n_name").alias("city"),
            _s("n_regionkey").alias("region_id"),
        ),
        "dim_customers": lambda: t("customer").select(
            _s("c_custkey").alias("customer_id"),
            _s("c_nationkey").alias("address_id"),
            null_s.alias("registration_date"),
        ),
        "dim_warehouses": lambda: t("supplier").join(
            t("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        ).select(
            _s("s_suppkey").alias("warehouse_id"),
            _s("n_regionkey").alias("region_id"),
        ),
        "dim_payment_methods": lambda: t("orders").select(
            F.substring("o_orderpriority", 1, 1).alias("method_id"),
            F.substring("o_orderpriority", 3, 20).alias("method_name"),
        ).distinct(),
        "dim_categories": lambda: t("part").select(
            F.col("p_type").alias("category_id"),
            F.col("p_type").alias("category_name"),
        ).distinct(),
        "dim_skus": lambda: t("part").select(
            _s("p_partkey").alias("sku_id"),
            F.col("p_type").alias("category_id"),
            F.col("p_retailprice").alias("baseline_price"),
        ),
        "fact_order_headers": lambda: t("orders").select(
            _s("o_orderkey").alias("order_id"),
            _s("o_custkey").alias("customer_id"),
            F.col("o_totalprice").alias("total_order_value"),
            _s("o_orderdate").alias("event_timestamp"),
        ),
        "fact_order_lines": lambda: t("lineitem").select(
            line_key().alias("line_id"),
            _s("l_orderkey").alias("order_id"),
            _s("l_partkey").alias("sku_id"),
            _s("l_suppkey").alias("warehouse_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").alias("line_value"),
        ),
        "fact_payments": lambda: t("orders").select(
            F.concat(F.lit("P"), _s("o_orderkey")).alias("payment_id"),
            _s("o_orderkey").alias("order_id"),
            F.substring("o_orderpriority", 1, 1).alias("method_id"),
            F.col("o_totalprice").alias("amount"),
            F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success").alias("payment_status"),
            F.when(
                F.col("o_orderstatus") == "F",
                _bucket(F.col("o_orderkey") % 10, FAILURE_REASON_BUCKETS, FAILURE_REASON_LAST),
            ).alias("failure_reason"),
            _s("o_orderdate").alias("event_timestamp"),
        ),
        "fact_shipments": lambda: t("orders").select(
            F.concat(F.lit("S"), _s("o_orderkey")).alias("shipment_id"),
            _s("o_orderkey").alias("order_id"),
            _bucket(F.col("o_custkey") % 10, COURIER_BUCKETS, COURIER_LAST).alias("courier_name"),
            F.when(F.col("o_orderstatus") == "P", "delivery_failed").otherwise("dispatched").alias("event_type"),
            _s("o_orderdate").alias("event_timestamp"),
        ),
        "fact_returns": lambda: t("lineitem").where(F.col("l_returnflag") == "R").select(
            F.concat(F.lit("R-"), line_key()).alias("return_id"),
            line_key().alias("line_id"),
            F.when(F.col("l_linenumber") <= 4, RETURN_REASON_UP_TO_4)
            .when(F.col("l_linenumber") == 5, RETURN_REASON_BY_LINE[5])
            .when(F.col("l_linenumber") == 6, RETURN_REASON_BY_LINE[6])
            .when(F.col("l_linenumber") == 7, RETURN_REASON_BY_LINE[7])
            .alias("return_reason"),
            F.lit("return_requested").alias("return_status"),
            _s("l_shipdate").alias("event_timestamp"),
        ),
        "fact_inventory_transactions": lambda: t("lineitem").select(
            F.concat(F.lit("T-"), line_key()).alias("transaction_id"),
            _s("l_partkey").alias("sku_id"),
            _s("l_suppkey").alias("warehouse_id"),
            F.when(F.col("l_linestatus") == "O", "stock_added")
            .when(F.col("l_linestatus") == "F", "stock_removed")
            .alias("event_type"),
            F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("int"))
            .when(F.col("l_linestatus") == "F", -F.col("l_quantity").cast("int"))
            .alias("quantity_change"),
            _s("l_shipdate").alias("event_timestamp"),
        ),
        "fact_user_clickstream": lambda: t("events").select(
            _s("event_id").alias("event_id"),
            _s("user_id").alias("customer_id"),
            F.get_json_object("props", "$.k").alias("sku_id"),
            _bucket(F.col("user_id") % 10, DEVICE_BUCKETS, DEVICE_LAST).alias("device_type"),
            F.col("event_type"),
            _s("ts").alias("event_timestamp"),
        ),
    }
    def conformed(name: str) -> DataFrame:
        """The view with the declared names, order and types."""
        return views[name]().select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields])

    return {name: lambda n=name: conformed(n) for name in SCHEMAS}
