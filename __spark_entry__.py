"""

``entry(spark)`` runs the flagship query on sf0.001; ``queries()`` maps
each registered query to a callable ``(spark, sf_dir) -> DataFrame``;
``oracle_sql()`` gives the matching DuckDB SQL over the driver's tables.
Every query reads the whole fixture tables (through the star views of
``starlens.sources.fixtures``).
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from starlens import oracle
from starlens.operators.analyses import ANALYSES
from starlens.operators.analyses import fine_revenue
from starlens.operators.questions import props_scope, question_scope, user_questions
from starlens.operators.rootcause import root_cause
from starlens.plans.report import DOMAINS, breakdown, domain_long, findings, report_long, report_signals, signals
from starlens.session import configure
from starlens.sources.layout import on_layout
from starlens.sources.star import Star
from starlens.sources.schemas import SCHEMAS
from starlens.sources.tables import MAX_LIMIT, recent_order_facts, recent_orders, recent_orders_labelled
from starlens.plans.lattice import asked_questions, report_by_question
from starlens.streaming.ingest import ingest_rejects, ingest_replay, ingest_roundtrip
from starlens.streaming.scenarios import ingest_all, ingest_drift, ingest_duplicates, ingest_recovery, report_incremental, truncate_then_ingest

SMOKE_DIR = "/root/testdata/sf0.001"

# Scope values used by the scoped variants (FIXTURES.md).
REGION = "ASIA"
CITY = "NATION_2"
CATEGORY = "PROMO"
COURIER = "COURIER_A"
RETURN_REASON = "damaged"
DEVICE = "mobile"
METHOD = "HIGH"
STATUS = "failed"

# query name -> (analysis, scope, extra keyword arguments)
SCOPED: dict[str, tuple[str, dict[str, str], dict]] = {
    "payment_failure_by_method": ("payment_failure_by_method", {}, {}),
    "payment_failure_by_method_region_city": ("payment_failure_by_method", {"region": REGION, "city": CITY}, {}),
    "payment_failure_by_method_status": ("payment_failure_by_method", {"payment_status": STATUS}, {}),
    "payment_failure_by_method_method": ("payment_failure_by_method", {"payment_method": METHOD}, {}),
    "payment_failure_by_reason": ("payment_failure_by_reason", {}, {}),
    "payment_failure_by_reason_method": ("payment_failure_by_reason", {"payment_method": METHOD}, {}),
    "payment_failure_by_reason_region": ("payment_failure_by_reason", {"region": REGION}, {}),
    "payment_failure_by_reason_status": ("payment_failure_by_reason", {"payment_status": STATUS}, {}),
    "orders_by_region": ("orders_by_region", {}, {}),
    "orders_by_region_category": ("orders_by_region", {"category": CATEGORY}, {}),
    "orders_by_region_category_dedupe": ("orders_by_region", {"category": CATEGORY}, {"dedupe": True}),
    "orders_by_region_city": ("orders_by_region", {"city": CITY}, {}),
    "revenue_by_category": ("revenue_by_category", {}, {}),
    "revenue_by_category_region": ("revenue_by_category", {"region": REGION}, {}),
    "courier_performance": ("courier_performance", {}, {}),
    "courier_performance_region": ("courier_performance", {"region": REGION}, {}),
    "courier_performance_courier": ("courier_performance", {"courier_name": COURIER}, {}),
    "shipments_by_region": ("shipments_by_region", {}, {}),
    "shipments_by_region_courier": ("shipments_by_region", {"courier_name": COURIER}, {}),
    "return_rate_by_sku": ("return_rate_by_sku", {}, {}),
    "return_rate_by_sku_reason": ("return_rate_by_sku", {"return_reason": RETURN_REASON}, {}),
    "return_rate_by_sku_category_region": ("return_rate_by_sku", {"category": CATEGORY, "region": REGION}, {}),
    "return_reasons": ("return_reasons", {}, {}),
    "return_reasons_region": ("return_reasons", {"region": REGION}, {}),
    "inventory_by_warehouse": ("inventory_by_warehouse", {}, {}),
    "inventory_by_warehouse_region": ("inventory_by_warehouse", {"region": REGION}, {}),
    "clickstream_by_device": ("clickstream_by_device", {}, {}),
    "clickstream_by_device_region": ("clickstream_by_device", {"region": REGION}, {}),
    "clickstream_funnel": ("clickstream_funnel", {}, {}),
    "clickstream_funnel_device": ("clickstream_funnel", {"device_type": DEVICE}, {}),
    "clickstream_funnel_region": ("clickstream_funnel", {"region": REGION}, {}),
    "orders_by_region_region": ("orders_by_region", {"region": REGION}, {}),
    "revenue_by_category_category": ("revenue_by_category", {"category": CATEGORY}, {}),
    "return_rate_by_sku_category": ("return_rate_by_sku", {"category": CATEGORY}, {}),
    "return_rate_by_sku_top25": ("return_rate_by_sku", {}, {"top_n": 25}),
    "return_reasons_reason": ("return_reasons", {"return_reason": RETURN_REASON}, {}),
    "shipments_by_region_region": ("shipments_by_region", {"region": REGION}, {}),
}

# One scope with every key: each analysis applies the keys it honours.
FULL_SCOPE = {"region": REGION, "city": CITY, "category": CATEGORY, "courier_name": COURIER,
              "return_reason": RETURN_REASON, "device_type": DEVICE, "payment_method": METHOD,
              "payment_status": STATUS}

ROOT_CAUSE_SCOPE = {"region": REGION, "courier_name": COURIER}


# Ingest queries whose name is not that of their table.
INGEST_NAMES = {"fact_payments": "payments", "fact_order_lines": "order_lines", "fact_returns": "returns",
                "fact_user_clickstream": "clickstream"}
SCOPED_SIGNALS: dict[str, tuple[str, dict[str, str]]] = {
    "signals_return_rate_by_sku_scoped": ("return_rate_by_sku", {"return_reason": "not_needed", "region": "EUROPE"}),
    "signals_clickstream_funnel_scoped": ("clickstream_funnel", {"device_type": "tablet", "region": "EUROPE"}),
    "signals_return_reasons_region": ("return_reasons", {"region": REGION}),
    "signals_clickstream_by_device_region": ("clickstream_by_device", {"region": REGION}),
}
# Queries over a layout of the tables they read.
LOCATED = ["dim_customers", "dim_customer_addresses", "dim_regions", "fact_order_headers"]
ON_LAYOUT: dict[str, tuple[Callable[[Star], DataFrame], list[str]]] = {
    "layout_shipments_by_region": (lambda star: ANALYSES["shipments_by_region"].run(star, {}), [*LOCATED, "fact_shipments"]),
    "layout_recent_order_facts": (lambda star: recent_order_facts(star, MAX_LIMIT),
                                  ["fact_order_headers", "fact_order_lines", "fact_payments", "fact_shipments"]),
}


def _optional(name: str):
    """The module, or None where it is not part of this copy of the repository."""
    try:
        return import_module(name)
    except ModuleNotFoundError as e:
        if e.name and (name == e.name or name.startswith(f"{e.name}.")):
            return None
        raise


LLM = _optional("starlens.llm.queries")
PIPELINE = _optional("corpus_pipeline") if LLM else None


def _star(spark: SparkSession, sf_dir: str) -> Star:
    return Star.from_fixtures(configure(spark), sf_dir)


def _breakdown_query(analysis: str, scope: dict, kw: dict) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ANALYSES[analysis].run(_star(spark, sf_dir), scope, **kw)

    return run


def _signals_query(analysis: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return signals(_star(spark, sf_dir), analysis)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: courier performance ("why is courier X performing poorly")
    with its signals attached as columns of the breakdown."""
    star = _star(spark, SMOKE_DIR)
    b = breakdown(star, "courier_performance")
    sig = signals(star, "courier_performance").withColumnRenamed("dimension", "courier_name")
    return b.join(
        sig.select("courier_name", "avg", "severity", "type"), "courier_name", "left"
    ).orderBy("courier_name")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        name: _breakdown_query(a, scope, kw) for name, (a, scope, kw) in SCOPED.items()
    }
    for a in ANALYSES:
        out[f"signals_{a}"] = _signals_query(a)
    out["report_long"] = lambda spark, d: report_long(_star(spark, d))
    out["report_signals"] = lambda spark, d: report_signals(_star(spark, d))
    out["findings"] = lambda spark, d: findings(_star(spark, d))
    out["report_long_region"] = lambda spark, d: report_long(_star(spark, d), {"region": REGION})
    out["report_signals_region"] = lambda spark, d: report_signals(_star(spark, d), {"region": REGION})
    out["report_long_full_scope"] = lambda spark, d: report_long(_star(spark, d), FULL_SCOPE)
    out["root_cause"] = lambda spark, d: root_cause(_star(spark, d))
    out["root_cause_region_courier"] = lambda spark, d: root_cause(_star(spark, d), ROOT_CAUSE_SCOPE)
    out["root_cause_category_reason"] = lambda spark, d: root_cause(
        _star(spark, d), {"category": CATEGORY, "return_reason": RETURN_REASON})
    out["recent_orders"] = lambda spark, d: recent_orders(_star(spark, d))
    out["recent_orders_clamped"] = lambda spark, d: recent_orders(_star(spark, d), 500)
    out["question_scope"] = lambda spark, d: question_scope(_star(spark, d), user_questions(spark, d))
    out["recent_orders_labelled"] = lambda spark, d: recent_orders_labelled(_star(spark, d))
    out["props_scope"] = lambda spark, d: props_scope(configure(spark), d)
    out["revenue_by_category_fine"] = lambda spark, d: fine_revenue(_star(spark, d), configure(spark), d)
    for domain in DOMAINS:
        out[f"domain_{domain}"] = lambda spark, d, domain=domain: domain_long(_star(spark, d), domain)
    out["domain_shipments_courier"] = lambda spark, d: domain_long(_star(spark, d), "shipments", {"courier_name": COURIER})
    out["domain_payments_region"] = lambda spark, d: domain_long(_star(spark, d), "payments", {"region": REGION})
    for t in SCHEMAS:
        out[f"ingest_{INGEST_NAMES.get(t, t)}"] = lambda spark, d, t=t: ingest_roundtrip(configure(spark), d, t)
    out["ingest_multi_batch"] = lambda spark, d: ingest_roundtrip(configure(spark), d, "fact_shipments", 8, 2).drop("batch_id")
    out["ingest_replay"] = lambda spark, d: ingest_replay(configure(spark), d, "fact_payments")
    out["ingest_rejects"] = lambda spark, d: ingest_rejects(configure(spark), d)
    out["report_by_question"] = lambda spark, d: report_by_question(_star(spark, d), asked_questions(spark, d))
    out["report_incremental"] = lambda spark, d: report_incremental(configure(spark), d)
    out["ingest_recovery"] = lambda spark, d: ingest_recovery(configure(spark), d)
    out["ingest_all"] = lambda spark, d: ingest_all(configure(spark), d)
    out["ingest_duplicates"] = lambda spark, d: ingest_duplicates(configure(spark), d)
    out["ingest_drift"] = lambda spark, d: ingest_drift(configure(spark), d)
    out["truncate_then_ingest"] = lambda spark, d: truncate_then_ingest(configure(spark), d)
    for name, (query, tables) in ON_LAYOUT.items():
        out[name] = lambda spark, d, q=query, t=tables: on_layout(_star(spark, d), q, t)
    for name, (analysis, scope) in SCOPED_SIGNALS.items():
        out[name] = lambda spark, d, a=analysis, sc=scope: signals(_star(spark, d), a, sc)
    if LLM:
        out |= LLM.QUERIES
    if PIPELINE:
        out["pipeline"] = PIPELINE.run
    return out


def oracle_sql() -> dict[str, str]:
    out = {
        name: oracle.breakdown_sql(a, scope, **kw) for name, (a, scope, kw) in SCOPED.items()
    }
    for a in ANALYSES:
        out[f"signals_{a}"] = oracle.signals_sql(a)
    out["report_long"] = oracle.report_long_sql()
    out["report_signals"] = oracle.report_signals_sql()
    out["findings"] = oracle.findings_sql()
    out["report_long_region"] = oracle.report_long_sql({"region": REGION})
    out["report_signals_region"] = oracle.report_signals_sql({"region": REGION})
    out["report_long_full_scope"] = oracle.report_long_sql(FULL_SCOPE)
    out["root_cause"] = oracle.root_cause_sql()
    out["root_cause_region_courier"] = oracle.root_cause_sql(ROOT_CAUSE_SCOPE)
    out["root_cause_category_reason"] = oracle.root_cause_sql({"category": CATEGORY, "return_reason": RETURN_REASON})
    out["recent_orders"] = oracle.recent_orders_sql()
    out["recent_orders_clamped"] = oracle.recent_orders_sql(500)
    out["question_scope"] = oracle.question_scope_sql()
    out["recent_orders_labelled"] = oracle.recent_orders_labelled_sql()
    out["props_scope"] = oracle.props_scope_sql()
    out["revenue_by_category_fine"] = oracle.fine_revenue_sql()
    for domain in DOMAINS:
        out[f"domain_{domain}"] = oracle.domain_sql(domain)
    out["domain_shipments_courier"] = oracle.domain_sql("shipments", {"courier_name": COURIER})
    out["domain_payments_region"] = oracle.domain_sql("payments", {"region": REGION})
    for t in SCHEMAS:
        out[f"ingest_{INGEST_NAMES.get(t, t)}"] = oracle.star_table_sql(t)
    out["ingest_multi_batch"] = oracle.star_table_sql("fact_shipments")
    out["ingest_replay"] = oracle.star_table_sql("fact_payments")
    out["ingest_rejects"] = oracle.ingest_rejects_sql()
    out["report_by_question"] = oracle.report_by_question_sql()
    out["report_incremental"] = oracle.report_long_sql()
    out["ingest_recovery"] = oracle.ingest_recovery_sql()
    out["ingest_all"] = oracle.ingest_all_sql()
    out["ingest_duplicates"] = oracle.star_table_sql("fact_payments")
    out["ingest_drift"] = oracle.ingest_drift_sql()
    out["truncate_then_ingest"] = oracle.truncate_then_ingest_sql()
    out["layout_shipments_by_region"] = oracle.breakdown_sql("shipments_by_region", {})
    out["layout_recent_order_facts"] = oracle.recent_order_facts_sql(MAX_LIMIT)
    for name, (analysis, scope) in SCOPED_SIGNALS.items():
        out[name] = oracle.signals_sql(analysis, scope)
    if LLM:
        out |= LLM.ORACLES
    if PIPELINE and PIPELINE.ORACLE_SQL:
        out["pipeline"] = PIPELINE.ORACLE_SQL
    return out
