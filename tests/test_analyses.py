"""Analyses on hand-made stars: scope matrix, join elision, traps T1-T5."""

from __future__ import annotations

import pytest
from conftest import make_star, rows

from starlens.functions.scope import HONOURED, SCOPE_KEYS, Scope
from starlens.operators import analyses as A
from starlens.operators.rootcause import root_cause

REGIONS = [("r1", "West", None), ("r2", "East", None)]
ADDRESSES = [("a1", "Pune", "r1"), ("a2", "Delhi", "r2")]
CUSTOMERS = [("c1", "a1", None), ("c2", "a2", None)]
METHODS = [("m1", "UPI"), ("m2", "Card")]
CATEGORIES = [("k1", "Home"), ("k2", "Toys")]
SKUS = [("s1", "k1", 10.0), ("s2", "k2", 20.0)]
WAREHOUSES = [("w1", "r1"), ("w2", "r2")]


@pytest.fixture(scope="module")
def star(spark):
    return make_star(
        spark,
        dim_regions=REGIONS,
        dim_customer_addresses=ADDRESSES,
        dim_customers=CUSTOMERS,
        dim_payment_methods=METHODS,
        dim_categories=CATEGORIES,
        dim_skus=SKUS,
        dim_warehouses=WAREHOUSES,
        fact_order_headers=[
            ("o1", "c1", 100.0, "2024-01-01 00:00:00"),
            ("o2", "c2", 50.0, "2024-01-02 00:00:00"),
            ("o3", "c1", 30.0, "2024-01-03 00:00:00"),
            ("o4", "cX", 7.0, "2024-01-04 00:00:00"),  # dangling customer
        ],
        fact_order_lines=[
            ("l1", "o1", "s1", "w1", 1, 10.0),
            ("l2", "o1", "s1", "w1", 2, 20.0),  # second Home line of o1 (fan-out)
            ("l3", "o1", "s2", "w2", 1, 20.0),
            ("l4", "o2", "s2", "w2", 1, 20.0),
            ("l5", "o3", "s1", "w1", 3, 30.0),
        ],
        fact_payments=[
            ("p1", "o1", "m1", 100.0, "failed", "gateway_error", "t"),
            ("p2", "o2", "m1", 50.0, "success", None, "t"),
            ("p3", "o3", "m2", 30.0, "failed", "timeout", "t"),
            ("p4", "o4", "m2", 7.0, "success", None, "t"),
            ("p5", "o1", "mX", 1.0, "failed", "gateway_error", "t"),  # dangling method
        ],
        fact_shipments=[
            ("h1", "o1", "A", "dispatched", "t"),
            ("h2", "o2", "A", "delivery_failed", "t"),
            ("h3", "o3", "B", "dispatched", "t"),
            ("h4", "o4", "B", "dispatched", "t"),  # order with dangling customer
        ],
        fact_returns=[
            ("x1", "l1", "damaged", "return_requested", "t"),
            ("x2", "l3", "wrong_item", "return_requested", "t"),
            ("x3", "l5", "damaged", "return_requested", "t"),
            ("x4", "l5", "damaged", "return_requested", "t"),  # duplicate return of one line
        ],
        fact_inventory_transactions=[
            ("i1", "s1", "w1", "stock_added", 5, "t"),
            ("i2", "s1", "w1", "stock_removed", -2, "t"),
            ("i3", "s2", "w2", "stock_removed", -4, "t"),
            ("i4", "s2", "w2", None, 1, "t"),  # null type counts as stock out
        ],
        fact_user_clickstream=[
            ("e1", "c1", "s1", "mobile", "view", "t"),
            ("e2", "c1", "s1", "mobile", "click", "t"),
            ("e3", "c2", "s2", "desktop", "view", "t"),
            ("e4", "cX", "s2", "tablet", "view", "t"),  # dangling customer
        ],
    )


def test_payment_failure_by_method(star):
    out = rows(A.payment_failure_by_method(star))
    # ordered by failure rate desc, tie-break by name
    assert out == [("Card", 2, 1, 50.0), ("UPI", 2, 1, 50.0)]


def test_payment_failure_by_method_region(star):
    out = rows(A.payment_failure_by_method(star, {"region": "West"}))
    assert out == [("Card", 1, 1, 100.0), ("UPI", 1, 1, 100.0)]


def test_payment_failure_by_reason_elides_method_join(star):
    # unscoped: the dangling-method payment p5 is counted
    assert rows(A.payment_failure_by_reason(star)) == [("gateway_error", 2), ("timeout", 1)]
    # a method scope joins methods and drops it
    assert rows(A.payment_failure_by_reason(star, {"payment_method": "UPI"})) == [("gateway_error", 1)]


def test_payment_status_scope_on_reasons(star):
    # Applied as a filter; success leaves nothing (the reference errors to [])
    assert rows(A.payment_failure_by_reason(star, {"payment_status": "success"})) == []
    assert rows(A.payment_failure_by_reason(star, {"payment_status": "failed"})) == [
        ("gateway_error", 2), ("timeout", 1)
    ]


def test_orders_by_region_fan_out_and_dedupe(star):
    assert rows(A.orders_by_region(star)) == [("West", 2, 130.0), ("East", 1, 50.0)]
    # o1 has two Home lines, so its value counts twice
    assert rows(A.orders_by_region(star, {"category": "Home"})) == [("West", 2, 230.0)]
    assert rows(A.orders_by_region(star, {"category": "Home"}, dedupe=True)) == [("West", 2, 130.0)]


def test_revenue_by_category(star):
    assert rows(A.revenue_by_category(star)) == [("Home", 2, 60.0), ("Toys", 2, 40.0)]
    assert rows(A.revenue_by_category(star, {"region": "East"})) == [("Toys", 1, 20.0)]


def test_courier_performance_keeps_dangling_when_unscoped(star):
    assert rows(A.courier_performance(star)) == [("A", 2, 1, 50.0), ("B", 2, 0, 0.0)]
    # with a region scope the order with a dangling customer is lost
    assert rows(A.courier_performance(star, {"region": "West"})) == [("A", 1, 0, 0.0), ("B", 1, 0, 0.0)]


def test_shipments_by_region(star):
    assert rows(A.shipments_by_region(star)) == [("West", 2), ("East", 1)]
    assert rows(A.shipments_by_region(star, {"courier_name": "B"})) == [("West", 1)]


def test_return_rate_by_sku(star):
    # s1: returns x1, x3, x4 over orders o1, o3 -> 150 %; s2: x2 over o1, o2 -> 50 %
    assert rows(A.return_rate_by_sku(star)) == [("s1", 3, 2, 150.0), ("s2", 1, 2, 50.0)]
    # The reason filter keeps only returned lines
    assert rows(A.return_rate_by_sku(star, {"return_reason": "damaged"})) == [("s1", 3, 2, 150.0)]
    assert rows(A.return_rate_by_sku(star, top_n=1)) == [("s1", 3, 2, 150.0)]
    assert rows(A.return_rate_by_sku(star, top_n=0)) == []
    with pytest.raises(ValueError):
        A.return_rate_by_sku(star, top_n=-1)


def test_return_reasons(star):
    assert rows(A.return_reasons(star)) == [("damaged", 3), ("wrong_item", 1)]
    assert rows(A.return_reasons(star, {"region": "West"})) == [("damaged", 3), ("wrong_item", 1)]


def test_inventory_by_warehouse(star):
    # null event_type: not 'stock_added' -> in SQL the CASE falls to ELSE 0 for
    # both stock_in and stock_out, but the row still counts in net and events
    assert rows(A.inventory_by_warehouse(star)) == [("w2", 0, -4, -3, 2), ("w1", 5, -2, 3, 2)]
    assert rows(A.inventory_by_warehouse(star, {"region": "West"})) == [("w1", 5, -2, 3, 2)]


def test_clickstream(star):
    assert rows(A.clickstream_by_device(star)) == [("mobile", 2), ("desktop", 1), ("tablet", 1)]
    assert rows(A.clickstream_by_device(star, {"region": "West"})) == [("mobile", 2)]
    assert rows(A.clickstream_funnel(star)) == [("view", 3), ("click", 1)]
    assert rows(A.clickstream_funnel(star, {"device_type": "mobile"})) == [("click", 1), ("view", 1)]


def test_null_scope_value_matches_nothing(star):
    assert rows(A.courier_performance(star, {"courier_name": None})) == []


def test_scope_matrix_ignored_keys_do_not_change_results(star):
    probe = {"region": "West", "city": "Pune", "courier_name": "A", "payment_status": "failed",
             "payment_method": "UPI", "device_type": "mobile", "return_reason": "damaged", "category": "Home"}
    assert set(probe) == set(SCOPE_KEYS)
    for name, a in A.ANALYSES.items():
        honoured = HONOURED[name]
        base = sorted(map(tuple, a.run(star, {}).collect()))
        for key in probe:
            got = sorted(map(tuple, a.run(star, {key: probe[key]}).collect()))
            if key not in honoured:
                assert got == base, (name, key)


def test_scope_builder_keeps_allowed_order():
    sc = Scope({"courier_name": "Delhivery", "region": "West India", "sku_id": "x"})
    conds = sc.conditions(["region", "courier_name"])
    assert [str(c) for c in conds] == [
        str(sc.equals("region", "region_name")), str(sc.equals("courier_name", "courier_name"))
    ]
    assert sc.conditions(["payment_status"]) == []


def test_root_cause(star):
    out = rows(root_cause(star))
    # x1 (l1: o1 A, s1 Home, w1), x2 (l3: o1 A, s2 Toys, w2), x3, x4 (l5: o3 B, s1 Home, w1)
    assert out == [
        ("B", "damaged", "w1", "Home", 2),
        ("A", "damaged", "w1", "Home", 1),
        ("A", "wrong_item", "w2", "Toys", 1),
    ]
    assert rows(root_cause(star, {"courier_name": "A", "region": "West"})) == [
        ("A", "damaged", "w1", "Home", 1), ("A", "wrong_item", "w2", "Toys", 1)
    ]


@pytest.mark.parametrize("scope", [{}, {"payment_method": "UPI"}, {"payment_status": "failed"},
                                   {"region": "West"}, {"payment_method": "Card", "region": "West"}])
def test_payments_from_one_scan_equal_separate(star, scope):
    by_method, by_reason = A.payments_both(star, scope)
    assert sorted(rows(by_method)) == sorted(rows(A.payment_failure_by_method(star, scope)))
    assert sorted(rows(by_reason)) == sorted(rows(A.payment_failure_by_reason(star, scope)))


def test_payments_from_one_scan_declines_city(star):
    assert A.payments_both(star, {"city": "Pune"}) is None


def test_clickstream_from_one_scan_equal_separate(star):
    for scope in ({}, {"region": "West"}, {"device_type": "mobile"}):
        both = rows(A.clickstream_both(star, scope), "key", "label", "count")
        assert sorted((l, c) for k, l, c in both if k == "device_type") == sorted(
            rows(A.clickstream_by_device(star, scope)))
        assert sorted((l, c) for k, l, c in both if k == "event_type") == sorted(rows(A.clickstream_funnel(star, scope)))


@pytest.mark.parametrize("scope", [{"region": "West"}, {"region": "East", "courier_name": "A"}])
def test_shipments_from_one_scan_equal_separate(star, scope):
    by_courier, by_region = A.shipments_both(star, scope)
    assert sorted(rows(by_courier)) == sorted(rows(A.courier_performance(star, scope)))
    assert sorted(rows(by_region)) == sorted(rows(A.shipments_by_region(star, scope)))
    assert A.shipments_both(star, {"courier_name": "A"}) is None
