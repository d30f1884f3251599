"""Exact numeric helpers shared by the analyses.

Money is summed as ``decimal(28,10)``, which keeps the decimals that are
stored, and rounded once, after the sum; sums do not depend on row order
(T7).  A group that holds a NaN or an infinity gets what a floating sum of
these gives (NaN, or the infinity), as in SQL over doubles.  Ratios are rounded half away from zero, as SQL ``ROUND(numeric, 2)``
does, with integer arithmetic only, so no intermediate rounding can move a
result across a half (T6).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,10)"
WIDE = "decimal(38,0)"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c: str | Column, times: Column | None = None) -> Column:
    """``ROUND(SUM(x)::numeric, 2)`` as a double; ``times`` counts each value
    so often (an integer of at most nine digits)."""
    c = _c(c)
    odd = F.isnan(c) | (F.abs(c) == float("inf"))
    value = F.when(~odd, c).cast(MONEY)
    if times is not None:
        value = value * times.cast("decimal(9,0)")
    return F.coalesce(F.sum(F.when(odd, c.cast("double"))), F.round(F.sum(value), 2).cast("double"))


def round_half_up_ratio(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """``ROUND(num / NULLIF(den, 0), scale)`` rounded half away from zero,
    as a double.  ``num`` must carry at most ``scale`` decimals (counts,
    money); ``den`` is a positive count.  Null when ``den`` is 0 or null."""
    num, den = _c(num), _c(den)
    unit = 10 ** scale
    scaled = (num.cast("decimal(38,%d)" % scale) * unit).cast(WIDE)
    den = den.cast(WIDE)
    x = F.abs(scaled) * 2 + den
    y = den * 2
    quotient = (x - F.pmod(x, y)) / y  # exact: x - pmod(x, y) is a multiple of y
    value = F.signum(scaled).cast(WIDE) * quotient / unit
    return F.when(den != 0, value.cast("double"))


def pct(num: str | Column, den: str | Column) -> Column:
    """``ROUND(100.0 * num / NULLIF(den, 0), 2)``."""
    return round_half_up_ratio(_c(num).cast("long") * 100, den, 2)
