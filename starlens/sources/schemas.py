"""The fourteen star tables: one schema used by the stream decoder, the batch
reader and every sink (A3), their logical keys and their topic names (A4).

All ids are strings and every field is nullable, as the events arrive as flat
JSON objects with no guarantees.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _fields(*spec: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in spec])


S, D, I = StringType(), DoubleType(), IntegerType()

# Table names, column names and types of the star schema.
SCHEMAS: dict[str, StructType] = {
    "dim_regions": _fields(("region_id", S), ("region_name", S), ("country", S)),
    "dim_categories": _fields(("category_id", S), ("category_name", S)),
    "dim_skus": _fields(("sku_id", S), ("category_id", S), ("baseline_price", D)),
    "dim_customer_addresses": _fields(("address_id", S), ("city", S), ("region_id", S)),
    "dim_customers": _fields(("customer_id", S), ("address_id", S), ("registration_date", S)),
    "dim_warehouses": _fields(("warehouse_id", S), ("region_id", S)),
    "dim_payment_methods": _fields(("method_id", S), ("method_name", S)),
    "fact_order_headers": _fields(
        ("order_id", S), ("customer_id", S), ("total_order_value", D), ("event_timestamp", S)
    ),
    "fact_order_lines": _fields(
        ("line_id", S), ("order_id", S), ("sku_id", S), ("warehouse_id", S),
        ("quantity", I), ("line_value", D),
    ),
    "fact_payments": _fields(
        ("payment_id", S), ("order_id", S), ("method_id", S), ("amount", D),
        ("payment_status", S), ("failure_reason", S), ("event_timestamp", S),
    ),
    "fact_shipments": _fields(
        ("shipment_id", S), ("order_id", S), ("courier_name", S), ("event_type", S),
        ("event_timestamp", S),
    ),
    "fact_returns": _fields(
        ("return_id", S), ("line_id", S), ("return_reason", S), ("return_status", S),
        ("event_timestamp", S),
    ),
    "fact_inventory_transactions": _fields(
        ("transaction_id", S), ("sku_id", S), ("warehouse_id", S), ("event_type", S),
        ("quantity_change", I), ("event_timestamp", S),
    ),
    "fact_user_clickstream": _fields(
        ("event_id", S), ("customer_id", S), ("sku_id", S), ("device_type", S),
        ("event_type", S), ("event_timestamp", S),
    ),
}

# Logical (unenforced) key of each table: the first column.
KEYS: dict[str, str] = {name: schema.fields[0].name for name, schema in SCHEMAS.items()}

DIMENSIONS = [n for n in SCHEMAS if n.startswith("dim_")]
FACTS = [n for n in SCHEMAS if n.startswith("fact_")]


def topic_for(table: str) -> str:
    """Topic (or landing folder) carrying the events of ``table``."""
    return f"topic_{table}"


TOPICS: dict[str, str] = {name: topic_for(name) for name in SCHEMAS}
