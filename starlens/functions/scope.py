"""Scope: a flat mapping of scope key to value, applied as ANDed equalities
(B3-B5).

A key that an analysis does not honour is ignored (and logged); a key that
names a dimension makes the analysis join that dimension, which the
analysis does only when the key is present (join elision, C12).
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger("starlens.scope")

# Scope keys and the star column each one filters.
SCOPE_KEYS = {
    "category": ("dim_categories", "category_name"),
    "city": ("dim_customer_addresses", "city"),
    "courier_name": ("fact_shipments", "courier_name"),
    "device_type": ("fact_user_clickstream", "device_type"),
    "payment_method": ("dim_payment_methods", "method_name"),
    "payment_status": ("fact_payments", "payment_status"),
    "region": ("dim_regions", "region_name"),
    "return_reason": ("fact_returns", "return_reason"),
}

# The scope matrix, the keys each analysis honours.
HONOURED = {
    "payment_failure_by_method": ("payment_status", "payment_method", "region", "city"),
    "payment_failure_by_reason": ("payment_status", "payment_method", "region"),
    "orders_by_region": ("region", "city", "category"),
    "revenue_by_category": ("category", "region"),
    "courier_performance": ("courier_name", "region"),
    "shipments_by_region": ("region", "courier_name"),
    "return_rate_by_sku": ("return_reason", "category", "region"),
    "return_reasons": ("return_reason", "region"),
    "inventory_by_warehouse": ("region",),
    "clickstream_by_device": ("device_type", "region"),
    "clickstream_funnel": ("device_type", "region"),
    "root_cause": ("return_reason", "courier_name", "category", "region", "city"),
}


class Scope(Mapping[str, str | None]):
    """Immutable scope.  Values are compared as text; a null value matches
    nothing (``col = NULL``)."""

    def __init__(self, items: Mapping[str, object] | None = None, **kw: object):
        merged = dict(items or {})
        merged.update(kw)
        self._items = {k: (None if v is None else str(v)) for k, v in merged.items()}

    def __getitem__(self, key: str) -> str | None:
        return self._items[key]

    def __iter__(self):
        return iter(self._items)

    def __len__(self) -> int:
        return len(self._items)

    def __repr__(self) -> str:
        return f"Scope({self._items!r})"

    def for_analysis(self, analysis: str) -> "Scope":
        """The part of the scope an analysis honours; the rest is logged."""
        allowed = HONOURED[analysis]
        ignored = [k for k in self._items if k not in allowed]
        if ignored:
            log.info("%s ignores scope keys %s", analysis, ignored)
        return Scope({k: v for k, v in self._items.items() if k in allowed})

    def has(self, *keys: str) -> bool:
        return any(k in self._items for k in keys)

    def equals(self, key: str, column: str | Column) -> Column:
        col = F.col(column) if isinstance(column, str) else column
        return col == F.lit(self._items[key]).cast("string")

    def conditions(self, keys: Sequence[str], columns: Mapping[str, str | Column] | None = None) -> list[Column]:
        """Equalities for ``keys`` present in the scope, in ``keys`` order.
        ``columns`` maps a key to its column; by default the key's star column."""
        out = []
        for key in keys:
            if key in self._items:
                column = (columns or {}).get(key, SCOPE_KEYS[key][1])
                out.append(self.equals(key, column))
        return out

    def apply(self, df: DataFrame, keys: Sequence[str], columns: Mapping[str, str | Column] | None = None) -> DataFrame:
        conds = self.conditions(keys, columns)
        return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def as_scope(scope: Mapping[str, object] | None) -> Scope:
    return scope if isinstance(scope, Scope) else Scope(scope or {})
