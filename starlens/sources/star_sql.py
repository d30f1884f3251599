"""The fixture star views as plain SQL over the driver's tables, for the
independent oracle (DuckDB).  Same mapping as ``fixtures.py``, written
separately in SQL."""

from __future__ import annotations

LK = (
    "concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
    "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(CAST(l_quantity AS INTEGER) AS VARCHAR))"
)

STAR_SQL: dict[str, str] = {
    "dim_regions": "SELECT CAST(r_regionkey AS VARCHAR) AS region_id, r_name AS region_name, "
    "CAST(NULL AS VARCHAR) AS country FROM region",
    "dim_customer_addresses": "SELECT CAST(n_nationkey AS VARCHAR) AS address_id, n_name AS city, "
    "CAST(n_regionkey AS VARCHAR) AS region_id FROM nation",
    "dim_customers": "SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_nationkey AS VARCHAR) AS address_id, "
    "CAST(NULL AS VARCHAR) AS registration_date FROM customer",
    "dim_warehouses": "SELECT CAST(s_suppkey AS VARCHAR) AS warehouse_id, CAST(n_regionkey AS VARCHAR) AS region_id "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "dim_payment_methods": "SELECT DISTINCT substring(o_orderpriority, 1, 1) AS method_id, "
    "substring(o_orderpriority, 3, 20) AS method_name FROM orders",
    "dim_categories": "SELECT DISTINCT p_type AS category_id, p_type AS category_name FROM part",
    "dim_skus": "SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_type AS category_id, "
    "p_retailprice AS baseline_price FROM part",
    "fact_order_headers": "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, "
    "o_totalprice AS total_order_value, CAST(o_orderdate AS VARCHAR) AS event_timestamp FROM orders",
    "fact_order_lines": f"SELECT {LK} AS line_id, CAST(l_orderkey AS VARCHAR) AS order_id, "
    "CAST(l_partkey AS VARCHAR) AS sku_id, CAST(l_suppkey AS VARCHAR) AS warehouse_id, "
    "CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS line_value FROM lineitem",
    "fact_payments": "SELECT 'P' || CAST(o_orderkey AS VARCHAR) AS payment_id, CAST(o_orderkey AS VARCHAR) AS order_id, "
    "substring(o_orderpriority, 1, 1) AS method_id, o_totalprice AS amount, "
    "CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'success' END AS payment_status, "
    "CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 10 < 7 THEN 'gateway_error' "
    "WHEN o_orderkey % 10 < 9 THEN 'insufficient_funds' ELSE 'timeout' END END AS failure_reason, "
    "CAST(o_orderdate AS VARCHAR) AS event_timestamp FROM orders",
    "fact_shipments": "SELECT 'S' || CAST(o_orderkey AS VARCHAR) AS shipment_id, CAST(o_orderkey AS VARCHAR) AS order_id, "
    "CASE WHEN o_custkey % 10 < 5 THEN 'COURIER_A' WHEN o_custkey % 10 < 8 THEN 'COURIER_B' "
    "WHEN o_custkey % 10 < 9 THEN 'COURIER_C' ELSE 'COURIER_D' END AS courier_name, "
    "CASE WHEN o_orderstatus = 'P' THEN 'delivery_failed' ELSE 'dispatched' END AS event_type, "
    "CAST(o_orderdate AS VARCHAR) AS event_timestamp FROM orders",
    "fact_returns": f"SELECT 'R-' || {LK} AS return_id, {LK} AS line_id, "
    "CASE WHEN l_linenumber <= 4 THEN 'damaged' WHEN l_linenumber = 5 THEN 'wrong_item' "
    "WHEN l_linenumber = 6 THEN 'not_needed' WHEN l_linenumber = 7 THEN 'size_issue' END AS return_reason, "
    "'return_requested' AS return_status, CAST(l_shipdate AS VARCHAR) AS event_timestamp "
    "FROM lineitem WHERE l_returnflag = 'R'",
    "fact_inventory_transactions": f"SELECT 'T-' || {LK} AS transaction_id, CAST(l_partkey AS VARCHAR) AS sku_id, "
    "CAST(l_suppkey AS VARCHAR) AS warehouse_id, "
    "CASE WHEN l_linestatus = 'O' THEN 'stock_added' WHEN l_linestatus = 'F' THEN 'stock_removed' END AS event_type, "
    "CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS INTEGER) "
    "WHEN l_linestatus = 'F' THEN -CAST(l_quantity AS INTEGER) END AS quantity_change, "
    "CAST(l_shipdate AS VARCHAR) AS event_timestamp FROM lineitem",
    "fact_user_clickstream": "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id, "
    "json_extract_string(props, '$.k') AS sku_id, "
    "CASE WHEN user_id % 10 < 6 THEN 'mobile' WHEN user_id % 10 < 9 THEN 'desktop' ELSE 'tablet' END AS device_type, "
    "event_type, CAST(ts AS VARCHAR) AS event_timestamp FROM events",
}


def with_star(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the CTEs of every star table it (or an ``extra``
    CTE) mentions, followed by the ``extra`` CTEs in order."""
    extra = list(extra or [])
    text = body + " ".join(sql for _, sql in extra)
    ctes = [(name, sql) for name, sql in STAR_SQL.items() if name in text] + extra
    if not ctes:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes) + "\n" + body
