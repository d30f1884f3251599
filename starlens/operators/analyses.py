"""The eleven operational analyses.

Each takes the star and a scope and returns its breakdown as an ordered
DataFrame.  A dimension is joined only when the analysis needs it or a
scope key asks for it (C12): unscoped results keep facts whose foreign key
dangles, scoped ones lose them, as in the reference.

Orders are the reference's, with the group key as tie-break (T4) and
nulls first on descending, last on ascending sorts (T5).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.functions.numeric import money_sum, pct
from starlens.functions.scope import Scope, as_scope
from starlens.operators import dims
from starlens.sources.star import Star

DEFAULT_TOP_N = 10
MAX_HINTED_TOP = 10_000  # a longer top list is joined without a broadcast hint


def _count() -> Column:
    return F.count(F.lit(1))


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def _desc(metric: str, key: str) -> list[Column]:
    return [F.desc_nulls_first(metric), F.asc_nulls_last(key)]


def _ordered(df: DataFrame, ordered: bool, *order: Column) -> DataFrame:
    """The breakdown in the reference's order; unordered when the caller
    consumes it as a set (the long report), which saves a global sort."""
    return df.orderBy(*order) if ordered else df


def _methods(star: Star, sc: Scope) -> DataFrame:
    methods = sc.apply(star["dim_payment_methods"].select("method_id", "method_name"), ["payment_method"])
    return star.broadcast(methods, "dim_payment_methods")


# ── payments ─────────────────────────────────────────────────────────────


def payment_failure_by_method(star: Star, scope: Mapping | None = None, ordered: bool = True) -> DataFrame:
    """Payments and failure rate per payment method."""
    sc = as_scope(scope).for_analysis("payment_failure_by_method")
    fp = sc.apply(star["fact_payments"].select("order_id", "method_id", "payment_status"), ["payment_status"])
    if sc.has("region", "city"):
        fp = dims.by_order_location(fp, star, sc)
    # Pre-aggregate on the join key, so the method dimension meets one row per
    # method id instead of one per payment; re-summing after the join keeps
    # the counts exact when a method id occurs more than once.
    per_id = fp.groupBy("method_id").agg(
        _count().alias("_total"),
        _count_if(F.col("payment_status") == "failed").alias("_failed"),
    )
    agg = per_id.join(_methods(star, sc), "method_id").groupBy("method_name").agg(
        F.sum("_total").alias("total"), F.sum("_failed").alias("failed")
    )
    out = agg.select("method_name", "total", "failed", pct("failed", "total").alias("failure_rate_pct"))
    return _ordered(out, ordered, *_desc("failure_rate_pct", "method_name"))


def payment_failure_by_reason(star: Star, scope: Mapping | None = None, ordered: bool = True) -> DataFrame:
    """Failed payments per failure reason.  A payment_status scope is
    applied as a filter (the reference's query errors out instead, T1)."""
    sc = as_scope(scope).for_analysis("payment_failure_by_reason")
    fp = star["fact_payments"].select("order_id", "method_id", "payment_status", "failure_reason")
    fp = sc.apply(fp, ["payment_status"]).where(
        (F.col("payment_status") == "failed") & F.col("failure_reason").isNotNull()
    )
    if sc.has("region"):
        fp = dims.by_order_location(fp, star, sc)
    if sc.has("payment_method"):
        per_id = fp.groupBy("method_id", "failure_reason").agg(_count().alias("_n"))
        agg = per_id.join(_methods(star, sc), "method_id").groupBy("failure_reason").agg(
            F.sum("_n").alias("count")
        )
    else:
        agg = fp.groupBy("failure_reason").agg(_count().alias("count"))
    return _ordered(agg, ordered, *_desc("count", "failure_reason"))


def payments_both(star: Star, scope: Mapping | None = None) -> tuple[DataFrame, DataFrame] | None:
    """E1 and E2 from one scan of the payments, unordered, or ``None`` when
    the scope makes them read different rows (``city`` is honoured by E1
    only).  One grouping-sets aggregate counts payments per method id and
    failed payments per (method id, reason); each analysis then finishes on
    that small result, joining the method dimension exactly when it would
    on its own."""
    sc1 = as_scope(scope).for_analysis("payment_failure_by_method")
    sc2 = as_scope(scope).for_analysis("payment_failure_by_reason")
    if sc1.has("city"):
        return None
    fp = sc1.apply(
        star["fact_payments"].select("order_id", "method_id", "payment_status", "failure_reason"), ["payment_status"]
    )
    if sc1.has("region"):
        fp = dims.by_order_location(fp, star, sc1)
    failed = F.col("payment_status") == "failed"
    g = fp.groupingSets([["method_id"], ["method_id", "failure_reason"]], "method_id", "failure_reason").agg(
        _count().alias("_total"),
        _count_if(failed).alias("_failed"),
        _count_if(failed & F.col("failure_reason").isNotNull()).alias("_reasoned"),
        F.grouping_id().alias("_gid"),
    )
    per_method = g.where(F.col("_gid") == 1)
    per_reason = g.where((F.col("_gid") == 0) & (F.col("_reasoned") > 0))

    by_method = per_method.join(_methods(star, sc1), "method_id").groupBy("method_name").agg(
        F.sum("_total").alias("total"), F.sum("_failed").alias("failed")
    )
    by_method = by_method.select("method_name", "total", "failed", pct("failed", "total").alias("failure_rate_pct"))
    if sc2.has("payment_method"):
        per_reason = per_reason.join(_methods(star, sc2), "method_id")
    by_reason = per_reason.groupBy("failure_reason").agg(F.sum("_reasoned").alias("count"))
    return by_method, by_reason


# ── orders ───────────────────────────────────────────────────────────────


def orders_by_region(star: Star, scope: Mapping | None = None, dedupe: bool = False,
                     ordered: bool = True) -> DataFrame:
    """Distinct orders and revenue per customer region.

    With a category scope the reference joins order lines, so an order's
    value is counted once per matching line (T2).  That result is kept; the
    lines are first reduced to one row per order with its number of matching
    lines, and the value is weighted by it.  ``dedupe=True`` counts each
    order once instead.
    """
    sc = as_scope(scope).for_analysis("orders_by_region")
    headers = star["fact_order_headers"].select("order_id", "customer_id", "total_order_value")
    located = dims.by_customer_location(headers, star, sc)
    times = None
    if sc.has("category"):
        lines = star["fact_order_lines"].select("order_id", "sku_id").join(
            dims.small_sku_category(star, sc), "sku_id"
        )
        if dedupe:
            located = located.join(lines.select("order_id"), "order_id", "left_semi")
        else:
            per_order = lines.groupBy("order_id").agg(_count().alias("_lines"))
            located = located.join(per_order, "order_id")
            times = F.col("_lines")
    agg = located.groupBy("region_name").agg(
        F.count_distinct("order_id").alias("order_count"),
        money_sum("total_order_value", times).alias("total_revenue"),
    )
    return _ordered(agg, ordered, *_desc("order_count", "region_name"))


def revenue_by_category(star: Star, scope: Mapping | None = None, ordered: bool = True) -> DataFrame:
    """Distinct orders and line revenue per category."""
    sc = as_scope(scope).for_analysis("revenue_by_category")
    lines = star["fact_order_lines"].select("order_id", "sku_id", "line_value")
    j = lines.join(dims.small_sku_category(star, sc), "sku_id")
    if sc.has("region"):
        j = dims.by_order_location(j, star, sc)
    agg = j.groupBy("category_name").agg(
        F.count_distinct("order_id").alias("order_count"),
        money_sum("line_value").alias("total_revenue"),
    )
    return _ordered(agg, ordered, *_desc("total_revenue", "category_name"))


def fine_revenue(star: Star, spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 over line values of more than two decimals: the price after discount and tax."""
    lines = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_partkey").cast("string").alias("sku_id"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("line_value"))
    return revenue_by_category(Star(spark, {**star, "fact_order_lines": lines}))


# ── shipments ────────────────────────────────────────────────────────────


def courier_performance(star: Star, scope: Mapping | None = None, ordered: bool = True) -> DataFrame:
    """E5: shipments and delivery failure rate per courier."""
    sc = as_scope(scope).for_analysis("courier_performance")
    fs = sc.apply(star["fact_shipments"].select("order_id", "courier_name", "event_type"), ["courier_name"])
    if sc.has("region"):
        fs = dims.by_order_location(fs, star, sc)
    agg = fs.groupBy("courier_name").agg(
        _count().alias("total_shipments"),
        _count_if(F.col("event_type") == "delivery_failed").alias("failed"),
    )
    out = agg.select(
        "courier_name", "total_shipments", "failed",
        pct("failed", "total_shipments").alias("failure_rate_pct"),
    )
    return _ordered(out, ordered, *_desc("total_shipments", "courier_name"))


def shipments_by_region(star: Star, scope: Mapping | None = None, ordered: bool = True) -> DataFrame:
    """Shipments per customer region."""
    sc = as_scope(scope).for_analysis("shipments_by_region")
    fs = sc.apply(star["fact_shipments"].select("shipment_id", "order_id", "courier_name"), ["courier_name"])
    j = dims.by_order_location(fs, star, sc)
    agg = j.groupBy("region_name").agg(F.count("shipment_id").alias("shipment_count"))
    return _ordered(agg, ordered, *_desc("shipment_count", "region_name"))


def shipments_both(star: Star, scope: Mapping | None = None) -> tuple[DataFrame, DataFrame] | None:
    """E5 and E6 from one scan of the shipments, unordered, or ``None``
    without a region scope (then E5 keeps shipments whose order does not
    resolve to a customer location, and E6 does not, so they read different
    rows).  Both honour the same keys, so with a region they read the same
    located shipments; grouping sets count per courier and per region."""
    sc = as_scope(scope).for_analysis("courier_performance")
    if not sc.has("region"):
        return None
    fs = sc.apply(
        star["fact_shipments"].select("shipment_id", "order_id", "courier_name", "event_type"), ["courier_name"]
    )
    located = dims.by_order_location(fs, star, sc)
    g = located.groupingSets([["courier_name"], ["region_name"]], "courier_name", "region_name").agg(
        _count().alias("_total"),
        _count_if(F.col("event_type") == "delivery_failed").alias("_failed"),
        F.count("shipment_id").alias("_shipments"),
        F.grouping_id().alias("_gid"),
    )
    by_courier = g.where(F.col("_gid") == 1).select(
        "courier_name",
        F.col("_total").alias("total_shipments"),
        F.col("_failed").alias("failed"),
        pct("_failed", "_total").alias("failure_rate_pct"),
    )
    by_region = g.where(F.col("_gid") == 2).select("region_name", F.col("_shipments").alias("shipment_count"))
    return by_courier, by_region


# ── returns ──────────────────────────────────────────────────────────────


def return_rate_by_sku(star: Star, scope: Mapping | None = None, top_n: int = DEFAULT_TOP_N,
                       ordered: bool = True) -> DataFrame:
    """The ``top_n`` SKUs by number of returns, with distinct orders and
    returns per order.  A return_reason scope filters after the outer join,
    so it keeps only returned lines (T3).  The result is always ordered: the
    top-k is the feature (``ordered`` is accepted for a uniform signature)."""
    if top_n < 0:
        raise ValueError("top_n must not be negative")
    sc = as_scope(scope).for_analysis("return_rate_by_sku")
    lines = star["fact_order_lines"].select("line_id", "order_id", "sku_id")
    returns = sc.apply(star["fact_returns"].select("return_id", "line_id", "return_reason"), ["return_reason"])

    def in_scope(df: DataFrame) -> DataFrame:
        if sc.has("category"):
            df = df.join(dims.small_sku_category(star, sc), "sku_id")
        return dims.by_order_location(df, star, sc) if sc.has("region") else df

    # Only returned lines count returns, so the top SKUs need no outer join.
    returned = in_scope(lines.join(returns, "line_id"))
    metric = F.count("return_id").alias("return_count")
    if sc.has("return_reason"):
        agg = returned.groupBy("sku_id").agg(metric, F.count_distinct("order_id").alias("order_count"))
        agg = agg.where(F.col("return_count") > 0)
    else:
        top = returned.groupBy("sku_id").agg(metric).where(F.col("return_count") > 0)
        top = top.orderBy(*_desc("return_count", "sku_id")).limit(top_n).select(F.col("sku_id").alias("_sku"), "return_count")
        if top_n <= MAX_HINTED_TOP:
            top = F.broadcast(top)  # at most top_n rows
        # Distinct orders are counted over all lines, but of the top SKUs only.
        orders = in_scope(lines.join(top, F.col("sku_id").eqNullSafe(F.col("_sku"))))
        agg = orders.groupBy("sku_id", "return_count").agg(F.count_distinct("order_id").alias("order_count"))
    return (
        agg.select(
            "sku_id", "return_count", "order_count",
            pct("return_count", "order_count").alias("return_rate_pct"),
        )
        .orderBy(*_desc("return_count", "sku_id"))
        .limit(top_n)
    )


def return_reasons(star: Star, scope: Mapping | None = None, ordered: bool = True) -> DataFrame:
    """Returns per reason."""
    sc = as_scope(scope).for_analysis("return_reasons")
    fr = sc.apply(star["fact_returns"].select("line_id", "return_reason"), ["return_reason"])
    if sc.has("region"):
        fr = fr.join(star["fact_order_lines"].select("line_id", "order_id"), "line_id")
        fr = dims.by_order_location(fr, star, sc)
    agg = fr.groupBy("return_reason").agg(_count().alias("count"))
    return _ordered(agg, ordered, *_desc("count", "return_reason"))


# ── inventory ────────────────────────────────────────────────────────────


def inventory_by_warehouse(star: Star, scope: Mapping | None = None, ordered: bool = True) -> DataFrame:
    """Stock in, stock out, net change and events per warehouse.  A
    region scope is the warehouse's region."""
    sc = as_scope(scope).for_analysis("inventory_by_warehouse")
    fit = star["fact_inventory_transactions"].select("warehouse_id", "event_type", "quantity_change")
    added = F.col("event_type") == "stock_added"
    qc = F.col("quantity_change")
    agg = fit.groupBy("warehouse_id").agg(
        F.sum(F.when(added, qc).otherwise(0)).alias("stock_in"),
        F.sum(F.when(F.col("event_type") != "stock_added", qc).otherwise(0)).alias("stock_out"),
        F.sum(qc).alias("net_change"),
        _count().alias("total_events"),
    )
    if sc.has("region"):
        # The breakdown is per warehouse already: aggregate first, then keep
        # the warehouses of the region (re-summed, exact under duplicates).
        measures = ["stock_in", "stock_out", "net_change", "total_events"]
        agg = (
            agg.join(star.broadcast(dims.warehouse_region(star, sc), "dim_warehouses", "dim_regions"), "warehouse_id")
            .groupBy("warehouse_id")
            .agg(*[F.sum(m).alias(m) for m in measures])
        )
    return _ordered(agg, ordered, F.asc_nulls_last("net_change"), F.asc_nulls_last("warehouse_id"))


# ── clickstream ──────────────────────────────────────────────────────────


def _clicks(star: Star, sc: Scope) -> DataFrame:
    """Click events in scope.  A region scope joins the customers' locations
    before anything is counted: a small customer side is broadcast and the
    count needs no exchange on the customer; a large one is a plain join,
    which AQE splits where one customer is hot."""
    fuc = sc.apply(
        star["fact_user_clickstream"].select("customer_id", "device_type", "event_type"), ["device_type"]
    )
    return dims.by_customer_location(fuc, star, sc) if sc.has("region") else fuc


def clickstream_both(star: Star, scope: Mapping | None = None) -> DataFrame:
    """E10 and E11 from one scan of the clickstream: (key, label, count) with
    ``key`` either ``device_type`` or ``event_type``.  The two analyses
    honour the same scope keys, so they read the same rows; grouping sets
    aggregate both groupings in one pass (the rows are expanded once per set
    and combined map-side before the shuffle)."""
    sc = as_scope(scope).for_analysis("clickstream_by_device")
    g = _clicks(star, sc).groupingSets([["device_type"], ["event_type"]], "device_type", "event_type").agg(
        _count().alias("n"), F.grouping_id().alias("_gid")
    )
    by_device = F.col("_gid") == 1  # event_type rolled up
    return g.select(
        F.when(by_device, "device_type").otherwise("event_type").alias("key"),
        F.when(by_device, F.col("device_type")).otherwise(F.col("event_type")).alias("label"),
        F.col("n").alias("count"),
    )


def clickstream_by_device(star: Star, scope: Mapping | None = None, ordered: bool = True) -> DataFrame:
    """Click events per device type."""
    sc = as_scope(scope).for_analysis("clickstream_by_device")
    agg = _clicks(star, sc).groupBy("device_type").agg(_count().alias("event_count"))
    return _ordered(agg, ordered, *_desc("event_count", "device_type"))


def clickstream_funnel(star: Star, scope: Mapping | None = None, ordered: bool = True) -> DataFrame:
    """Click events per event type (plain counts, not an ordered funnel)."""
    sc = as_scope(scope).for_analysis("clickstream_funnel")
    agg = _clicks(star, sc).groupBy("event_type").agg(_count().alias("count"))
    return _ordered(agg, ordered, *_desc("count", "event_type"))


# ── registry ─────────────────────────────────────────────────────────────


@dataclass(frozen=True)
class Analysis:
    name: str
    domain: str
    section: str
    run: Callable[..., DataFrame]
    label: str
    value: str
    value_null_as_zero: bool = False
    sort: str = ""  # the metric it is ordered by, where that is not the signal value
    ascending: bool = False

    def signal_value(self) -> Column:
        v = F.col(self.value)
        return F.coalesce(v, F.lit(0)) if self.value_null_as_zero else v

    def order(self) -> list[Column]:
        """The order of its breakdown."""
        metric = self.sort or self.value
        if self.ascending:
            return [F.asc_nulls_last(metric), F.asc_nulls_last(self.label)]
        return _desc(metric, self.label)


ANALYSES: dict[str, Analysis] = {
    a.name: a
    for a in [
        Analysis("payment_failure_by_method", "payments", "by_method", payment_failure_by_method,
                 "method_name", "failure_rate_pct", True),
        Analysis("payment_failure_by_reason", "payments", "by_reason", payment_failure_by_reason,
                 "failure_reason", "count"),
        Analysis("orders_by_region", "orders", "by_region", orders_by_region, "region_name", "order_count"),
        Analysis("revenue_by_category", "orders", "by_category", revenue_by_category,
                 "category_name", "total_revenue", True),
        Analysis("courier_performance", "shipments", "courier_performance", courier_performance,
                 "courier_name", "total_shipments"),
        Analysis("shipments_by_region", "shipments", "by_region", shipments_by_region,
                 "region_name", "shipment_count"),
        Analysis("return_rate_by_sku", "returns", "top_skus", return_rate_by_sku, "sku_id", "return_count"),
        Analysis("return_reasons", "returns", "by_reason", return_reasons, "return_reason", "count"),
        Analysis("inventory_by_warehouse", "inventory", "by_warehouse", inventory_by_warehouse,
                 "warehouse_id", "net_change", ascending=True),
        Analysis("clickstream_by_device", "clickstream", "by_device", clickstream_by_device,
                 "device_type", "event_count"),
        Analysis("clickstream_funnel", "clickstream", "funnel", clickstream_funnel, "event_type", "count"),
    ]
}
