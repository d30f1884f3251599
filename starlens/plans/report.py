"""Reports over all analyses.

``run`` returns the nested report of the reference as a dict of lazy
DataFrames; ``report_long`` and ``report_signals`` flatten it into two
DataFrames, one row per group and one per signal, each a single Spark plan:
a union of the analysis branches, in which identical sub-plans (dimension
broadcasts, shared shuffles) are reused and the two clickstream analyses
read their fact once.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.functions.scope import as_scope
from starlens.operators.analyses import (
    ANALYSES,
    DEFAULT_TOP_N,
    clickstream_both,
    payments_both,
    shipments_both,
)
from starlens.operators.signals import detect
from starlens.plans.rank import with_rank
from starlens.sources.star import Star

DOMAINS = ("payments", "orders", "shipments", "returns", "inventory", "clickstream")


def breakdown(star: Star, name: str, scope: Mapping | None = None) -> DataFrame:
    return ANALYSES[name].run(star, as_scope(scope))


def signals(star: Star, name: str, scope: Mapping | None = None) -> DataFrame:
    """I1 applied to one analysis: the signals of its breakdown."""
    a = ANALYSES[name]
    return detect(a.run(star, as_scope(scope), ordered=False), a.label, a.signal_value())


def run(star: Star, scope: Mapping | None = None) -> dict:
    """Every analysis for one scope, nested by domain."""
    sc = as_scope(scope)
    report: dict = {"scope": dict(sc)}
    for domain in DOMAINS:
        report[domain] = {}

    def build(a):
        return {
            "breakdown": a.run(star, sc),
            "signals": detect(a.run(star, sc, ordered=False), a.label, a.signal_value()),
        }

    analyses = list(ANALYSES.values())
    star.check_dimensions()  # the one job here; the threads build plans only
    with ThreadPoolExecutor(max_workers=len(analyses)) as pool:
        entries = list(pool.map(build, analyses))
    for a, entry in zip(analyses, entries):
        if a.name == "return_rate_by_sku":
            entry["top_n"] = DEFAULT_TOP_N
        report[a.domain][a.section] = entry
    return report


def domain_report(star: Star, domain: str, scope: Mapping | None = None) -> dict:
    """The analyses of one domain."""
    if domain not in DOMAINS:
        raise ValueError(f"unknown domain {domain!r}; expected one of {DOMAINS}")
    sc = as_scope(scope)
    return {
        a.section: {
            "breakdown": a.run(star, sc),
            "signals": detect(a.run(star, sc, ordered=False), a.label, a.signal_value()),
        }
        for a in ANALYSES.values()
        if a.domain == domain
    }


def _long(star: Star, name: str, scope) -> DataFrame:
    a = ANALYSES[name]
    return a.run(star, scope, ordered=False).select(
        F.lit(name).alias("analysis"),
        F.col(a.label).cast("string").alias("dimension"),
        a.signal_value().cast("double").alias("value"),
    )


def _clickstream_long(star: Star, scope) -> DataFrame:
    """Both clickstream analyses from one scan (grouping sets)."""
    both = clickstream_both(star, scope)
    return both.select(
        F.when(F.col("key") == "device_type", "clickstream_by_device")
        .otherwise("clickstream_funnel").alias("analysis"),
        F.col("label").cast("string").alias("dimension"),
        F.col("count").cast("double").alias("value"),
    )


def _payments_long(star: Star, scope) -> DataFrame:
    """Both payment analyses from one scan when the scope allows it."""
    both = payments_both(star, scope)
    if both is None:
        return _long(star, "payment_failure_by_method", scope).unionByName(
            _long(star, "payment_failure_by_reason", scope)
        )
    by_method, by_reason = both
    return by_method.select(
        F.lit("payment_failure_by_method").alias("analysis"),
        F.col("method_name").cast("string").alias("dimension"),
        F.coalesce(F.col("failure_rate_pct"), F.lit(0)).cast("double").alias("value"),
    ).unionByName(by_reason.select(
        F.lit("payment_failure_by_reason").alias("analysis"),
        F.col("failure_reason").cast("string").alias("dimension"),
        F.col("count").cast("double").alias("value"),
    ))


def _shipments_long(star: Star, scope) -> DataFrame:
    """Both shipment analyses from one scan when the scope has a region."""
    both = shipments_both(star, scope)
    if both is None:
        return _long(star, "courier_performance", scope).unionByName(_long(star, "shipments_by_region", scope))
    by_courier, by_region = both
    return by_courier.select(
        F.lit("courier_performance").alias("analysis"),
        F.col("courier_name").cast("string").alias("dimension"),
        F.col("total_shipments").cast("double").alias("value"),
    ).unionByName(by_region.select(
        F.lit("shipments_by_region").alias("analysis"),
        F.col("region_name").cast("string").alias("dimension"),
        F.col("shipment_count").cast("double").alias("value"),
    ))


# Analyses computed together in the long report, from one scan of their fact.
FUSED = {
    ("clickstream_by_device", "clickstream_funnel"): _clickstream_long,
    ("payment_failure_by_method", "payment_failure_by_reason"): _payments_long,
    ("courier_performance", "shipments_by_region"): _shipments_long,
}


def report_long(star: Star, scope: Mapping | None = None) -> DataFrame:
    """(analysis, dimension, value) for every group of every analysis.

    The dimensions' sizes are checked once, in one job; after that the branch
    plans are only built here, and building them from a thread pool overlaps
    the driver-side analysis of each plan.
    """
    sc = as_scope(scope)
    star.check_dimensions()
    fused = {name for group in FUSED for name in group}
    builders = [lambda n=n: _long(star, n, sc) for n in ANALYSES if n not in fused]
    builders += [lambda f=f: f(star, sc) for f in FUSED.values()]
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        parts = list(pool.map(lambda build: build(), builders))
    return reduce(DataFrame.unionByName, parts)


def domain_long(star: Star, domain: str, scope: Mapping | None = None) -> DataFrame:
    """J1/J2 of one domain in long form: (section, rank, dimension, value,
    severity, type), a row per group of each of its analyses, in the order of
    its breakdown (rank from 1), with the group's signal if it has one."""
    if domain not in DOMAINS:
        raise ValueError(f"unknown domain {domain!r}; expected one of {DOMAINS}")
    sc = as_scope(scope)
    parts = []
    for a in (a for a in ANALYSES.values() if a.domain == domain):
        b = a.run(star, sc, ordered=False)
        hits = detect(b, a.label, a.signal_value()).select(F.col("dimension").alias("_d"), "severity", "type")
        ranked = with_rank(b, a.order())  # a breakdown can have as many groups as there are warehouses
        long = ranked.select(F.col(a.label).cast("string").alias("dimension"), a.signal_value().cast("double").alias("value"), "rank")
        parts.append(long.join(hits, F.col("dimension").eqNullSafe(F.col("_d")), "left").select(
            F.lit(a.section).alias("section"), "rank", "dimension", "value", "severity", "type"))
    return reduce(DataFrame.unionByName, parts)


def report_signals(star: Star, scope: Mapping | None = None) -> DataFrame:
    """(analysis, dimension, value, avg, severity, type) for all
    analyses, as one plan over ``report_long``: each analysis is a separate
    breakdown, its sum and count are joined back on the analysis name (at
    most eleven rows)."""
    return detect(report_long(star, scope), "dimension", "value", by=["analysis"])


def findings(star: Star, scope: Mapping | None = None) -> DataFrame:
    """The facts a written report may cite: one sentence per signal, and
    an explicit 'no anomalies' line for each analysis without signals."""
    sig = report_signals(star, scope)
    stated = sig.select(
        "analysis",
        F.lit("signal").alias("kind"),
        F.format_string(
            "%s %s: %s = %.2f against a mean of %.2f",
            F.col("severity"), F.col("type"), F.col("dimension"), F.col("value"), F.col("avg"),
        ).alias("finding"),
    )
    names = sig.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in ANALYSES])).alias("analysis")
    )
    flagged = sig.select("analysis").distinct()  # at most one row per analysis
    healthy = names.join(flagged, "analysis", "left_anti").select(
        "analysis",
        F.lit("healthy").alias("kind"),
        F.lit("no anomalies: operations look healthy").alias("finding"),
    )
    return stated.unionByName(healthy)


def investigate(star: Star, question: str) -> dict:
    """The question flow for one question: scope extracted from the text
    (J4), the full report for that scope (J1) and its findings (J5).  Only
    the one-row scope of the question is brought to the driver, to scope the
    report."""
    from starlens.operators.questions import question_scope

    spark = star.spark
    q = spark.createDataFrame([(0, question)], "qid long, text string")
    scope_json = question_scope(star, q, id_cols=("qid",)).select("scope_json").first()[0]
    scope = json.loads(scope_json)
    return {"query": question, "scope": scope, "report": run(star, scope), "findings": findings(star, scope)}
