"""Cross-domain root cause.

Returns joined to their order line, the order's shipments and the sku's
category, narrowed by any scope key, counted per
(courier, return reason, warehouse, category).  This is the drill-down the
reference describes in prose ("returns -> lines -> shipments by region and
courier") but never codes.  A Bloom filter over the returned lines meets the lines before their
shuffle, so about the returned ones are moved.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.functions.scope import as_scope
from starlens.operators import dims
from starlens.plans.bloom import might_join
from starlens.sources.star import Star

GROUP = ["courier_name", "return_reason", "warehouse_id", "category_name"]


def root_cause(star: Star, scope: Mapping | None = None) -> DataFrame:
    sc = as_scope(scope).for_analysis("root_cause")
    returns = sc.apply(star["fact_returns"].select("return_id", "line_id", "return_reason"), ["return_reason"])
    lines = star["fact_order_lines"].select("line_id", "order_id", "sku_id", "warehouse_id")
    shipments = sc.apply(star["fact_shipments"].select("order_id", "courier_name"), ["courier_name"])
    if sc.has(*dims.LOCATION_KEYS):
        # Both on the order: lines and returns then meet the orders in scope only.
        shipments = dims.by_order_location(shipments, star, sc)
    j = (
        returns.join(might_join(lines, returns, "line_id"), "line_id")
        .join(shipments, "order_id")
        .join(dims.small_sku_category(star, sc), "sku_id")
    )
    return (
        j.groupBy(*GROUP)
        .agg(F.count_distinct("return_id").alias("return_count"))
        .orderBy(F.desc_nulls_first("return_count"), *[F.asc_nulls_last(c) for c in GROUP])
    )
