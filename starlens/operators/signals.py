"""Anomaly signals over a breakdown.

For the groups of one breakdown, with ``avg`` the unweighted mean of their
values:

* fewer than two groups, or ``avg == 0``: no signal;
* ``value > 1.5 * avg``: a spike, ``HIGH`` when ``value > 2 * avg`` else
  ``MEDIUM``;
* otherwise ``value < 0.5 * avg``: a ``MEDIUM`` drop.

The comparisons are done without division (``2*v*n > 3*s`` and so on, with
``s`` the sum and ``n`` the number of groups) in decimal, so they are exact
and keep the literal rule for negative means (T9).

The sum and count come from a scalar subquery over the breakdown itself:
Spark computes it with a distributed partial aggregate and reuses the
breakdown's shuffle, so no group is ever gathered into one task and no join
is needed.  For several breakdowns at once (``by``), the per-breakdown
sums are joined back on the breakdown key, unhinted: one row per breakdown,
which AQE broadcasts when it has measured it as small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.functions.numeric import round_half_up_ratio

VALUE = "decimal(38,2)"
SIGNAL_COLUMNS = ["dimension", "value", "avg", "severity", "type"]


def _rules(v: Column, s: Column, n: Column) -> tuple[Column, Column, Column]:
    """(is_signal, severity, type) for a value v of a group of n with sum s."""
    eligible = (n >= 2) & (s != 0)
    spike = v * n * 2 > s * 3
    drop = v * n * 2 < s
    severity = F.when(spike & (v * n > s * 2), "HIGH").otherwise("MEDIUM")
    kind = F.when(spike, "spike").otherwise("drop")
    return eligible & (spike | drop), severity, kind


def detect(breakdown: DataFrame, label: str | Column, value: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """Signals of ``breakdown`` with columns ``by + SIGNAL_COLUMNS``.

    ``label`` and ``value`` are columns of the breakdown (one row per group).
    With ``by``, each distinct ``by`` value is a separate breakdown.
    """
    label_col = F.col(label) if isinstance(label, str) else label
    value_col = F.col(value) if isinstance(value, str) else value
    b = breakdown.select(
        *[F.col(c) for c in by],
        label_col.cast("string").alias("dimension"),
        value_col.cast(VALUE).alias("_v"),
    )
    if by:
        stats = b.groupBy(*by).agg(F.sum("_v").alias("_s"), F.count(F.lit(1)).alias("_n"))
        joined = b.join(stats, list(by))
        s, n = F.col("_s"), F.col("_n")
    else:
        st = b.select(
            F.struct(F.sum("_v").alias("s"), F.count(F.lit(1)).alias("n")).alias("st")
        ).scalar()
        joined, s, n = b, st["s"], st["n"]
    v = F.col("_v")
    hit, severity, kind = _rules(v, s, n)
    return joined.where(hit).select(
        *[F.col(c) for c in by],
        "dimension",
        v.cast("double").alias("value"),
        round_half_up_ratio(s, n, 2).alias("avg"),
        severity.alias("severity"),
        kind.alias("type"),
    )
