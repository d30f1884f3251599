"""Prebuilt dimension frames (C2, C5, C10) and the fact-to-location joins.

Every join here is the inner equi-join of the reference, so duplicated
dimension rows fan out exactly as they would in SQL.  Scope filters are
applied on the (small) dimension side before it is joined to a fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from starlens.functions.scope import Scope
from starlens.sources.star import Star

LOCATION_KEYS = ("region", "city")
# The dimensions that make up customer_location and sku_category, for their size checks.
LOCATION = ("dim_customers", "dim_customer_addresses", "dim_regions")
CATEGORY = ("dim_skus", "dim_categories")


def address_region(star: Star, scope: Scope) -> DataFrame:
    """(address_id, city, region_name): addresses joined to their region."""
    regions = scope.apply(star["dim_regions"].select("region_id", "region_name"), ["region"])
    addresses = scope.apply(star["dim_customer_addresses"].select("address_id", "city", "region_id"), ["city"])
    return addresses.join(star.broadcast(regions, "dim_regions"), "region_id").select("address_id", "city", "region_name")


def customer_location(star: Star, scope: Scope) -> DataFrame:
    """(customer_id, city, region_name): customers -> addresses -> regions."""
    customers = star["dim_customers"].select("customer_id", "address_id")
    places = star.broadcast(address_region(star, scope), "dim_customer_addresses", "dim_regions")
    return customers.join(places, "address_id").select("customer_id", "city", "region_name")


def sku_category(star: Star, scope: Scope) -> DataFrame:
    """(sku_id, category_name): skus -> categories."""
    categories = scope.apply(star["dim_categories"].select("category_id", "category_name"), ["category"])
    skus = star["dim_skus"].select("sku_id", "category_id")
    return skus.join(star.broadcast(categories, "dim_categories"), "category_id").select("sku_id", "category_name")


def warehouse_region(star: Star, scope: Scope) -> DataFrame:
    """(warehouse_id, region_name): warehouses -> regions."""
    regions = scope.apply(star["dim_regions"].select("region_id", "region_name"), ["region"])
    warehouses = star["dim_warehouses"].select("warehouse_id", "region_id")
    return warehouses.join(star.broadcast(regions, "dim_regions"), "region_id").select("warehouse_id", "region_name")


def small_sku_category(star: Star, scope: Scope) -> DataFrame:
    """``sku_category``, hinted for broadcast if its tables are small."""
    return star.broadcast(sku_category(star, scope), *CATEGORY)


def by_customer_location(fact: DataFrame, star: Star, scope: Scope) -> DataFrame:
    """``fact`` (with customer_id) joined to the scoped customer location."""
    return fact.join(star.broadcast(customer_location(star, scope), *LOCATION), "customer_id")


def orders_located(star: Star, scope: Scope) -> DataFrame:
    """(order_id, customer_id, city, region_name) of the order headers in scope:
    headers -> customers -> addresses -> regions."""
    headers = star["fact_order_headers"].select("order_id", "customer_id")
    return by_customer_location(headers, star, scope)


def by_order_location(fact: DataFrame, star: Star, scope: Scope) -> DataFrame:
    """``fact`` (with order_id) joined through its order header to the scoped
    customer location (C3, C6, C7)."""
    return fact.join(orders_located(star, scope).drop("customer_id"), "order_id")
