"""J1, J2, J3, J5 shapes on the fixture star."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

from starlens.plans.report import DOMAINS, domain_report, findings, report_long, run
from starlens.sources.star import Star


def test_run_nests_every_analysis(spark):
    star = Star.from_fixtures(spark, SF_SMALL)
    rep = run(star, {"region": "ASIA"})
    assert rep["scope"] == {"region": "ASIA"}
    assert set(rep) == {"scope", *DOMAINS}
    assert set(rep["payments"]) == {"by_method", "by_reason"}
    assert set(rep["orders"]) == {"by_region", "by_category"}
    assert set(rep["shipments"]) == {"courier_performance", "by_region"}
    assert set(rep["returns"]) == {"top_skus", "by_reason"}
    assert rep["returns"]["top_skus"]["top_n"] == 10
    assert set(rep["inventory"]) == {"by_warehouse"}
    assert set(rep["clickstream"]) == {"by_device", "funnel"}
    sig = rep["shipments"]["courier_performance"]["signals"]
    assert sig.columns == ["dimension", "value", "avg", "severity", "type"]
    assert rep["shipments"]["by_region"]["breakdown"].collect()[0]["region_name"] == "ASIA"


def test_domain_report(spark):
    star = Star.from_fixtures(spark, SF_SMALL)
    rep = domain_report(star, "returns", {"return_reason": "damaged"})
    assert set(rep) == {"top_skus", "by_reason"}
    assert [r[0] for r in rep["by_reason"]["breakdown"].collect()] == ["damaged"]
    with pytest.raises(ValueError):
        domain_report(star, "marketing")


def test_long_report_and_findings_cover_all_analyses(spark):
    star = Star.from_fixtures(spark, SF_SMALL)
    assert {r[0] for r in report_long(star).select("analysis").distinct().collect()} == {
        "payment_failure_by_method", "payment_failure_by_reason", "orders_by_region", "revenue_by_category",
        "courier_performance", "shipments_by_region", "return_rate_by_sku", "return_reasons",
        "inventory_by_warehouse", "clickstream_by_device", "clickstream_funnel",
    }
    f = findings(star).collect()
    assert len({r["analysis"] for r in f}) == 11
    assert all(r["kind"] in ("signal", "healthy") for r in f)
