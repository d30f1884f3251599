"""Independent SQL oracle for the registered queries (DuckDB dialect).

Each analysis is restated as plain SQL over the fixture star views of
``star_sql``, with the same conditional joins for scope keys (a dimension
is joined only when the analysis needs it or a scope key asks for it).
Numeric conventions that make both engines agree exactly:

* percentages: ``round(100 * a / b, 2)`` half away from zero, computed as
  ``(20000 * a + b) // (2 * b) / 100`` with integers (T6);
* money: the sum of the stored values, rounded once, after summing (T7);
* integer sums cast to BIGINT; NULLS FIRST on DESC, LAST on ASC (T5); the
  group key breaks ties under LIMIT (T4).
"""

from __future__ import annotations

from collections.abc import Mapping

from starlens.sources.star_sql import STAR_SQL, with_star

# Customer -> city and region, and sku -> category, as inline relations.
GEO = (
    "(SELECT cu.customer_id, ad.city, rg.region_name FROM dim_customers cu "
    "JOIN dim_customer_addresses ad USING (address_id) JOIN dim_regions rg USING (region_id))"
)
SKU_CAT = "(SELECT sk.sku_id, ct.category_name FROM dim_skus sk JOIN dim_categories ct USING (category_id))"
WH_REGION = "(SELECT wh.warehouse_id, rg.region_name FROM dim_warehouses wh JOIN dim_regions rg USING (region_id))"


def pct(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN NULL ELSE CAST((20000 * ({a}) + ({b})) // (2 * ({b})) AS DOUBLE) / 100 END"


def money(x: str) -> str:
    return f"CAST(ROUND(SUM(CAST({x} AS DECIMAL(38,10))), 2) AS DOUBLE)"


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _filters(scope: Mapping[str, str], columns: Mapping[str, str]) -> str:
    """``WHERE`` with one equality per scope key present in ``columns``."""
    conds = [f"{col} = {_q(scope[key])}" for key, col in columns.items() if key in scope]
    return ("WHERE " + " AND ".join(conds)) if conds else ""


def _and(where: str, *extra: str) -> str:
    conds = ([where[len("WHERE "):]] if where else []) + list(extra)
    return ("WHERE " + " AND ".join(conds)) if conds else ""


def _geo_of_order(alias: str) -> str:
    """Join the order header of ``alias.order_id`` and its customer's geography."""
    return (f"JOIN fact_order_headers hdr ON hdr.order_id = {alias}.order_id "
            f"JOIN {GEO} geo ON geo.customer_id = hdr.customer_id")


def payment_failure_by_method(scope: Mapping[str, str]) -> str:
    joins = _geo_of_order("pay") if ("region" in scope or "city" in scope) else ""
    where = _filters(scope, {"payment_status": "pay.payment_status", "payment_method": "meth.method_name",
                             "region": "geo.region_name", "city": "geo.city"})
    failed = "COUNT(*) FILTER (WHERE pay.payment_status = 'failed')"
    return f"""
SELECT meth.method_name AS method_name, COUNT(*) AS total, {failed} AS failed,
       {pct(failed, 'COUNT(*)')} AS failure_rate_pct
FROM fact_payments pay JOIN dim_payment_methods meth ON meth.method_id = pay.method_id
{joins}
{where}
GROUP BY meth.method_name
ORDER BY failure_rate_pct DESC NULLS FIRST, method_name"""


def payment_failure_by_reason(scope: Mapping[str, str]) -> str:
    joins = []
    if "payment_method" in scope:
        joins.append("JOIN dim_payment_methods meth ON meth.method_id = pay.method_id")
    if "region" in scope:
        joins.append(_geo_of_order("pay"))
    where = _filters(scope, {"payment_status": "pay.payment_status", "payment_method": "meth.method_name",
                             "region": "geo.region_name"})
    where = _and(where, "pay.payment_status = 'failed'", "pay.failure_reason IS NOT NULL")
    return f"""
SELECT pay.failure_reason AS failure_reason, COUNT(*) AS count
FROM fact_payments pay
{' '.join(joins)}
{where}
GROUP BY pay.failure_reason
ORDER BY count DESC NULLS FIRST, failure_reason"""


def orders_by_region(scope: Mapping[str, str], dedupe: bool = False) -> str:
    lines_in_cat = (f"SELECT ln.order_id FROM fact_order_lines ln JOIN {SKU_CAT} sc ON sc.sku_id = ln.sku_id "
                    f"WHERE sc.category_name = {_q(scope['category'])}") if "category" in scope else ""
    joins, extra = "", []
    if lines_in_cat and dedupe:
        extra.append(f"hdr.order_id IN ({lines_in_cat})")
    elif lines_in_cat:
        # one row per matching line: an order's value counts once per line
        joins = f"JOIN ({lines_in_cat}) cl ON cl.order_id = hdr.order_id"
    where = _and(_filters(scope, {"region": "geo.region_name", "city": "geo.city"}), *extra)
    return f"""
SELECT geo.region_name AS region_name, COUNT(DISTINCT hdr.order_id) AS order_count,
       {money('hdr.total_order_value')} AS total_revenue
FROM fact_order_headers hdr JOIN {GEO} geo ON geo.customer_id = hdr.customer_id
{joins}
{where}
GROUP BY geo.region_name
ORDER BY order_count DESC NULLS FIRST, region_name"""


def revenue_by_category(scope: Mapping[str, str]) -> str:
    joins = _geo_of_order("ln") if "region" in scope else ""
    where = _filters(scope, {"category": "sc.category_name", "region": "geo.region_name"})
    return f"""
SELECT sc.category_name AS category_name, COUNT(DISTINCT ln.order_id) AS order_count,
       {money('ln.line_value')} AS total_revenue
FROM fact_order_lines ln JOIN {SKU_CAT} sc ON sc.sku_id = ln.sku_id
{joins}
{where}
GROUP BY sc.category_name
ORDER BY total_revenue DESC NULLS FIRST, category_name"""


def courier_performance(scope: Mapping[str, str]) -> str:
    joins = _geo_of_order("shp") if "region" in scope else ""
    where = _filters(scope, {"courier_name": "shp.courier_name", "region": "geo.region_name"})
    failed = "COUNT(*) FILTER (WHERE shp.event_type = 'delivery_failed')"
    return f"""
SELECT shp.courier_name AS courier_name, COUNT(*) AS total_shipments, {failed} AS failed,
       {pct(failed, 'COUNT(*)')} AS failure_rate_pct
FROM fact_shipments shp
{joins}
{where}
GROUP BY shp.courier_name
ORDER BY total_shipments DESC NULLS FIRST, courier_name"""


def shipments_by_region(scope: Mapping[str, str]) -> str:
    where = _filters(scope, {"region": "geo.region_name", "courier_name": "shp.courier_name"})
    return f"""
SELECT geo.region_name AS region_name, COUNT(shp.shipment_id) AS shipment_count
FROM fact_shipments shp
{_geo_of_order('shp')}
{where}
GROUP BY geo.region_name
ORDER BY shipment_count DESC NULLS FIRST, region_name"""


def return_rate_by_sku(scope: Mapping[str, str], top_n: int = 10) -> str:
    joins = []
    if "category" in scope:
        joins.append(f"JOIN {SKU_CAT} sc ON sc.sku_id = ln.sku_id")
    if "region" in scope:
        joins.append(_geo_of_order("ln"))
    where = _filters(scope, {"return_reason": "rt.return_reason", "category": "sc.category_name",
                             "region": "geo.region_name"})
    return f"""
SELECT ln.sku_id AS sku_id, COUNT(rt.return_id) AS return_count, COUNT(DISTINCT ln.order_id) AS order_count,
       {pct('COUNT(rt.return_id)', 'COUNT(DISTINCT ln.order_id)')} AS return_rate_pct
FROM fact_order_lines ln LEFT JOIN fact_returns rt ON rt.line_id = ln.line_id
{' '.join(joins)}
{where}
GROUP BY ln.sku_id
HAVING COUNT(rt.return_id) > 0
ORDER BY return_count DESC NULLS FIRST, sku_id
LIMIT {int(top_n)}"""


def return_reasons(scope: Mapping[str, str]) -> str:
    joins = ""
    if "region" in scope:
        joins = "JOIN fact_order_lines ln ON ln.line_id = rt.line_id " + _geo_of_order("ln")
    where = _filters(scope, {"return_reason": "rt.return_reason", "region": "geo.region_name"})
    return f"""
SELECT rt.return_reason AS return_reason, COUNT(*) AS count
FROM fact_returns rt
{joins}
{where}
GROUP BY rt.return_reason
ORDER BY count DESC NULLS FIRST, return_reason"""


def inventory_by_warehouse(scope: Mapping[str, str]) -> str:
    joins = f"JOIN {WH_REGION} wr ON wr.warehouse_id = inv.warehouse_id" if "region" in scope else ""
    where = _filters(scope, {"region": "wr.region_name"})
    qty = "inv.quantity_change"
    return f"""
SELECT inv.warehouse_id AS warehouse_id,
       CAST(SUM(IF(inv.event_type = 'stock_added', {qty}, 0)) AS BIGINT) AS stock_in,
       CAST(SUM(IF(inv.event_type <> 'stock_added', {qty}, 0)) AS BIGINT) AS stock_out,
       CAST(SUM({qty}) AS BIGINT) AS net_change,
       COUNT(*) AS total_events
FROM fact_inventory_transactions inv
{joins}
{where}
GROUP BY inv.warehouse_id
ORDER BY net_change ASC NULLS LAST, warehouse_id"""


def _clicks(scope: Mapping[str, str], key: str, alias: str) -> str:
    joins = f"JOIN {GEO} geo ON geo.customer_id = clk.customer_id" if "region" in scope else ""
    where = _filters(scope, {"device_type": "clk.device_type", "region": "geo.region_name"})
    return f"""
SELECT clk.{key} AS {key}, COUNT(*) AS {alias}
FROM fact_user_clickstream clk
{joins}
{where}
GROUP BY clk.{key}
ORDER BY {alias} DESC NULLS FIRST, {key}"""


def clickstream_by_device(scope: Mapping[str, str]) -> str:
    return _clicks(scope, "device_type", "event_count")


def clickstream_funnel(scope: Mapping[str, str]) -> str:
    return _clicks(scope, "event_type", "count")


# analysis -> (builder, label column, signal value expression)
BREAKDOWNS = {
    "payment_failure_by_method": (payment_failure_by_method, "method_name", "COALESCE(failure_rate_pct, 0)"),
    "payment_failure_by_reason": (payment_failure_by_reason, "failure_reason", "count"),
    "orders_by_region": (orders_by_region, "region_name", "order_count"),
    "revenue_by_category": (revenue_by_category, "category_name", "COALESCE(total_revenue, 0)"),
    "courier_performance": (courier_performance, "courier_name", "total_shipments"),
    "shipments_by_region": (shipments_by_region, "region_name", "shipment_count"),
    "return_rate_by_sku": (return_rate_by_sku, "sku_id", "return_count"),
    "return_reasons": (return_reasons, "return_reason", "count"),
    "inventory_by_warehouse": (inventory_by_warehouse, "warehouse_id", "net_change"),
    "clickstream_by_device": (clickstream_by_device, "device_type", "event_count"),
    "clickstream_funnel": (clickstream_funnel, "event_type", "count"),
}


def breakdown_sql(name: str, scope: Mapping[str, str] | None = None, **kw) -> str:
    return with_star(BREAKDOWNS[name][0](scope or {}, **kw))


def _signal_select(src: str, analysis: str | None) -> str:
    """Signals of the (dimension, v100) rows of CTE ``src``; v100 is the
    value times 100 as an exact integer, s and n the sum and count over the
    whole breakdown."""
    head = f"'{analysis}' AS analysis, " if analysis else ""
    avg = ("CAST(CASE WHEN s >= 0 THEN (2 * s + n) // (2 * n) ELSE -((2 * -s + n) // (2 * n)) END AS DOUBLE) / 100")
    return f"""
SELECT {head}dimension, CAST(v100 AS DOUBLE) / 100 AS value, {avg} AS avg,
       CASE WHEN v100 * n * 2 > s * 3 AND v100 * n > s * 2 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       CASE WHEN v100 * n * 2 > s * 3 THEN 'spike' ELSE 'drop' END AS type
FROM (SELECT dimension, v100, SUM(v100) OVER () AS s, COUNT(*) OVER () AS n FROM {src}) w
WHERE n >= 2 AND s <> 0 AND (v100 * n * 2 > s * 3 OR v100 * n * 2 < s)"""


def _values_cte(name: str, scope: Mapping[str, str]) -> tuple[str, str]:
    builder, label, value = BREAKDOWNS[name]
    sql = (f"SELECT CAST({label} AS VARCHAR) AS dimension, "
           f"CAST(CAST({value} AS DECIMAL(38,2)) * 100 AS HUGEINT) AS v100 FROM ({builder(scope)}) b")
    return f"v_{name}", sql


def signals_sql(name: str, scope: Mapping[str, str] | None = None) -> str:
    cte = _values_cte(name, scope or {})
    return with_star(_signal_select(cte[0], None), [cte])


def report_long_sql(scope: Mapping[str, str] | None = None) -> str:
    parts = []
    for name, (builder, label, value) in BREAKDOWNS.items():
        parts.append(
            f"SELECT '{name}' AS analysis, CAST({label} AS VARCHAR) AS dimension, "
            f"CAST({value} AS DOUBLE) AS value FROM ({builder(scope or {})}) b_{name}"
        )
    return with_star("\nUNION ALL\n".join(parts))


def report_signals_sql(scope: Mapping[str, str] | None = None) -> str:
    ctes = [_values_cte(name, scope or {}) for name in BREAKDOWNS]
    body = "\nUNION ALL\n".join(_signal_select(cte, name) for (cte, _), name in zip(ctes, BREAKDOWNS))
    return with_star(body, ctes)


def findings_sql(scope: Mapping[str, str] | None = None) -> str:
    ctes = [_values_cte(name, scope or {}) for name in BREAKDOWNS]
    sig = "\nUNION ALL\n".join(_signal_select(cte, name) for (cte, _), name in zip(ctes, BREAKDOWNS))
    names = ", ".join(f"('{n}')" for n in BREAKDOWNS)
    body = f"""
SELECT analysis, 'signal' AS kind,
       printf('%s %s: %s = %.2f against a mean of %.2f', severity, type, dimension, value, avg) AS finding
FROM sig
UNION ALL
SELECT a.analysis, 'healthy' AS kind, 'no anomalies: operations look healthy' AS finding
FROM (VALUES {names}) a(analysis)
WHERE a.analysis NOT IN (SELECT analysis FROM sig)"""
    return with_star(body, ctes + [("sig", sig)])


def root_cause_sql(scope: Mapping[str, str] | None = None) -> str:
    scope = scope or {}
    joins = _geo_of_order("ln") if ("region" in scope or "city" in scope) else ""
    where = _filters(scope, {"return_reason": "rt.return_reason", "courier_name": "shp.courier_name",
                             "category": "sc.category_name", "region": "geo.region_name", "city": "geo.city"})
    return with_star(f"""
SELECT shp.courier_name AS courier_name, rt.return_reason AS return_reason, ln.warehouse_id AS warehouse_id,
       sc.category_name AS category_name, COUNT(DISTINCT rt.return_id) AS return_count
FROM fact_returns rt
JOIN fact_order_lines ln ON ln.line_id = rt.line_id
JOIN fact_shipments shp ON shp.order_id = ln.order_id
JOIN {SKU_CAT} sc ON sc.sku_id = ln.sku_id
{joins}
{where}
GROUP BY ALL
ORDER BY return_count DESC NULLS FIRST, 1, 2, 3, 4""")


def recent_orders_sql(limit: int = 20) -> str:
    return with_star(
        f"SELECT * FROM fact_order_headers ORDER BY event_timestamp DESC NULLS FIRST, order_id "
        f"LIMIT {min(int(limit), 100)}"
    )


def recent_order_facts_sql(limit: int = 20) -> str:
    return with_star(f"""
SELECT r.order_id, r.event_timestamp,
       (SELECT count(*) FROM fact_order_lines x WHERE x.order_id = r.order_id) AS lines,
       (SELECT coalesce(sum(quantity), 0)::BIGINT FROM fact_order_lines x WHERE x.order_id = r.order_id) AS quantity,
       (SELECT count(*) FROM fact_payments x WHERE x.order_id = r.order_id) AS payments,
       (SELECT count(*) FROM fact_payments x WHERE x.order_id = r.order_id AND payment_status = 'failed') AS failed,
       (SELECT count(*) FROM fact_shipments x WHERE x.order_id = r.order_id) AS shipments
FROM (SELECT * FROM fact_order_headers ORDER BY event_timestamp DESC NULLS FIRST, order_id LIMIT {min(int(limit), 100)}) r""")


def star_table_sql(table: str) -> str:
    """A star table as stored after ingest: the fixture view itself."""
    return with_star(f"SELECT * FROM {table}")


def recent_orders_labelled_sql() -> str:
    return with_star("""
SELECT row_number() OVER (ORDER BY event_timestamp DESC NULLS FIRST, order_id)::INTEGER AS rank, left(order_id, 4) AS label,
       left(CAST(CAST(event_timestamp AS TIMESTAMP) AS VARCHAR), 19) AS at, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS day
FROM (SELECT * FROM fact_order_headers ORDER BY event_timestamp DESC NULLS FIRST, order_id LIMIT 100) r""")


def props_scope_sql() -> str:
    return "SELECT event_id, len(json_keys(props))::INTEGER AS keys, json_extract_string(props, '$.k') AS k FROM events"


def fine_revenue_sql() -> str:
    value = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"
    return f"""
SELECT p_type AS category_name, COUNT(DISTINCT l_orderkey) AS order_count, {money(value)} AS total_revenue
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type ORDER BY total_revenue DESC, category_name"""


def ingest_rejects_sql() -> str:
    return with_star("""
SELECT CASE WHEN quantity > 45 OR quantity = 1 THEN 'reject' ELSE 'stored' END AS kind,
       CASE WHEN quantity > 45 THEN 'cut ' || line_id WHEN quantity = 1 THEN 'no key, order ' || order_id ELSE line_id END AS value
FROM fact_order_lines""")


# Domain -> its analyses with their sections and orders (metric, direction).
_DOMAINS = {
    "payments": [("payment_failure_by_method", "by_method", "failure_rate_pct DESC NULLS FIRST"),
                 ("payment_failure_by_reason", "by_reason", "count DESC NULLS FIRST")],
    "orders": [("orders_by_region", "by_region", "order_count DESC NULLS FIRST"),
               ("revenue_by_category", "by_category", "total_revenue DESC NULLS FIRST")],
    "shipments": [("courier_performance", "courier_performance", "total_shipments DESC NULLS FIRST"),
                  ("shipments_by_region", "by_region", "shipment_count DESC NULLS FIRST")],
    "returns": [("return_rate_by_sku", "top_skus", "return_count DESC NULLS FIRST"),
                ("return_reasons", "by_reason", "count DESC NULLS FIRST")],
    "inventory": [("inventory_by_warehouse", "by_warehouse", "net_change ASC NULLS LAST")],
    "clickstream": [("clickstream_by_device", "by_device", "event_count DESC NULLS FIRST"),
                    ("clickstream_funnel", "funnel", "count DESC NULLS FIRST")],
}


def domain_sql(domain: str, scope: Mapping[str, str] | None = None) -> str:
    parts = []
    for name, section, order in _DOMAINS[domain]:
        builder, label, value = BREAKDOWNS[name]
        parts.append(f"""
SELECT '{section}' AS section, rank, dimension, value,
       CASE WHEN hit THEN CASE WHEN value * n * 2 > s * 3 AND value * n > s * 2 THEN 'HIGH' ELSE 'MEDIUM' END END AS severity,
       CASE WHEN hit THEN CASE WHEN value * n * 2 > s * 3 THEN 'spike' ELSE 'drop' END END AS type
FROM (SELECT *, n >= 2 AND s <> 0 AND (value * n * 2 > s * 3 OR value * n * 2 < s) AS hit FROM (
  SELECT row_number() OVER (ORDER BY {order}, {label})::INTEGER AS rank, CAST({label} AS VARCHAR) AS dimension,
         CAST({value} AS DOUBLE) AS value, SUM(CAST({value} AS DOUBLE)) OVER () AS s, COUNT(*) OVER () AS n
  FROM ({builder(scope or {})}) b) w) h""")
    return with_star("\nUNION ALL\n".join(parts))


# Scope key -> (star table, column), as in functions/scope.py.
_SCOPE_COLUMNS = {
    "courier_name": ("fact_shipments", "courier_name"),
    "payment_status": ("fact_payments", "payment_status"),
    "device_type": ("fact_user_clickstream", "device_type"),
    "return_reason": ("fact_returns", "return_reason"),
    "region": ("dim_regions", "region_name"),
    "payment_method": ("dim_payment_methods", "method_name"),
    "category": ("dim_categories", "category_name"),
    "city": ("dim_customer_addresses", "city"),
}


def question_scope_sql() -> str:
    norm = "trim(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    values = " UNION ".join(
        f"SELECT '{key}' AS key, {col} AS value FROM {table}" for key, (table, col) in _SCOPE_COLUMNS.items()
    )
    vocab = (f"SELECT key, value, {norm.format(c='value')} AS norm FROM ({values}) v "
             f"WHERE value IS NOT NULL AND {norm.format(c='value')} <> ''")
    questions = (f"SELECT conv_id, turn, string_split({norm.format(c='text')}, ' ') AS toks "
                 "FROM conversations WHERE role = 'user'")
    ns = ("SELECT unnest(generate_series(1, (SELECT max(len(string_split(norm, ' '))) FROM vocab))) AS n")
    grams = ("SELECT conv_id, turn, array_to_string(list_slice(toks, i, i + n - 1), ' ') AS gram FROM "
             "(SELECT conv_id, turn, toks, n, unnest(generate_series(1, len(toks) - n + 1)) AS i "
             "FROM questions, ns WHERE len(toks) >= n) g")
    best = ("SELECT conv_id, turn, key, value FROM (SELECT conv_id, turn, key, value, row_number() OVER "
            "(PARTITION BY conv_id, turn, key ORDER BY length(value) DESC, value) AS rn "
            "FROM grams JOIN vocab ON grams.gram = vocab.norm) m WHERE rn = 1")
    body = """
SELECT q.conv_id, q.turn,
       '{' || coalesce(string_agg('"' || b.key || '":"' || b.value || '"', ',' ORDER BY b.key), '') || '}' AS scope_json,
       CAST(count(b.key) AS INTEGER) AS scope_keys
FROM conversations q LEFT JOIN best b ON q.conv_id = b.conv_id AND q.turn = b.turn
WHERE q.role = 'user'
GROUP BY q.conv_id, q.turn"""
    return with_star(body, [("vocab", vocab), ("questions", questions), ("ns", ns), ("grams", grams),
                            ("best", best)])


# The scopes that the phrases of ``plans.lattice`` name, in their order.
_PHRASE_SCOPES = [
    {}, {"region": "ASIA"}, {"courier_name": "COURIER_A"}, {"courier_name": "COURIER_A", "region": "ASIA"}, {"city": "NATION_2"},
    {"payment_method": "HIGH", "payment_status": "failed"}, {"category": "PROMO", "return_reason": "damaged"},
    {"device_type": "mobile", "region": "EUROPE"}, {"category": "PROMO", "region": "EUROPE", "return_reason": "not_needed"},
    {"category": "PROMO", "city": "NATION_2", "courier_name": "COURIER_A", "device_type": "mobile", "payment_method": "HIGH",
     "payment_status": "failed", "region": "ASIA", "return_reason": "damaged"},
]


def report_by_question_sql() -> str:
    parts = []
    for k, scope in enumerate(_PHRASE_SCOPES):
        for name, (builder, label, value) in BREAKDOWNS.items():
            parts.append(f"SELECT {k} AS k, '{name}' AS analysis, CAST({label} AS VARCHAR) AS dimension, CAST({value} AS DOUBLE) AS value "
                         f"FROM ({builder(scope)}) b")
    body = f"""
SELECT conv_id, turn, analysis, dimension, value FROM conversations
JOIN ({' UNION ALL '.join(parts)}) r ON k = (conv_id + turn) % {len(_PHRASE_SCOPES)} WHERE role = 'user'"""
    return with_star(body)


def ingest_recovery_sql() -> str:
    return with_star("SELECT payment_id, CASE order_id::BIGINT % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 3 END::BIGINT AS batch_id FROM fact_payments")


def ingest_all_sql() -> str:
    return with_star(" UNION ALL ".join(f"SELECT '{t}' AS table, count(*) AS rows FROM {t}" for t in STAR_SQL))


def ingest_drift_sql() -> str:
    counts = [("field", "NULL", "not json", "quantity > 45"), ("field", "'line_value'", "missing", "quantity = 13"),
              ("field", "'line_id'", "missing", "quantity = 1"), ("field", "'quantity'", "wrong type", "quantity = 7"),
              ("field", "'line_value'", "wrong type", "quantity = 30"), ("field", "'note'", "unknown", "quantity = 21"),
              ("reject", "NULL", "not json", "quantity > 45"), ("reject", "NULL", "wrong type: quantity", "quantity = 7"),
              ("reject", "NULL", "wrong type: line_value", "quantity = 30"), ("reject", "NULL", "no key", "quantity = 1")]
    parts = [f"SELECT '{source}' AS source, CAST({field} AS VARCHAR) AS field, '{kind}' AS kind, count(*) AS n FROM fact_order_lines WHERE {where} HAVING n > 0"
             for source, field, kind, where in counts]
    return with_star(" UNION ALL ".join(parts))


def truncate_then_ingest_sql() -> str:
    steps = [("stored", "order_id::BIGINT % 2 = 0"), ("half truncated", "order_id::BIGINT % 2 = 0"), ("truncated", "false"), ("went on", "order_id::BIGINT % 2 = 1")]
    return with_star(" UNION ALL ".join(f"SELECT '{step}' AS step, count(*) AS rows FROM fact_payments WHERE {where}" for step, where in steps))
