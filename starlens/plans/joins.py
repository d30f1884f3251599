"""Broadcast hints for dimensions of a checked size.

``small_tables`` decides for base dimension tables: the files of a table's
current listing must stay under a bound in bytes, and one job counts the rows
and distinct keys of all that do (partial counts in every task, one row each
after that).  A table within the bounds whose key is unique may be hinted, and
so may an inner join of such tables along their keys, which cannot have more
rows than its first table.  The verdict lives in the ``Star`` it was made for,
together with the listing it was made from: reading the tables again lists and
checks them again.  A layout keeps what was counted with its version
(``sources.layout``), so that no query counts there.  Everything else goes unhinted: Spark plans a sort-merge
join, and AQE may still broadcast from measured sizes.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bounds of one hinted table: rows, and bytes of its files.
DEFAULT_MAX_ROWS = 1_000_000
DEFAULT_MAX_BYTES = 32 * 1024 * 1024
ROWS_KEY, BYTES_KEY = "starlens.broadcast.maxRows", "starlens.broadcast.maxBytes"


def _bound(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def max_broadcast_rows(spark: SparkSession) -> int:
    return _bound(spark, ROWS_KEY, DEFAULT_MAX_ROWS)


def max_broadcast_bytes(spark: SparkSession) -> int:
    return _bound(spark, BYTES_KEY, DEFAULT_MAX_BYTES)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files, or of the local rows, that ``df`` reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def planned_bytes(df: DataFrame) -> int:
    """The bytes that Spark's planner expects of ``df``, by which it chooses joins."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


class Measure(NamedTuple):
    """Of a table: bytes of its files, rows, and whether its key is unique."""

    size: int
    rows: int
    unique: bool

    def note(self) -> str:
        return f"{self.size},{self.rows},{int(self.unique)}"

    @classmethod
    def noted(cls, note: str) -> "Measure":
        size, rows, unique = map(int, note.split(","))
        return cls(size, rows, bool(unique))


def measured(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> dict[str, Measure]:
    """Rows and uniqueness of the tables within the bound in bytes, in one job."""
    if not tables:
        return {}
    most_bytes = max_broadcast_bytes(next(iter(tables.values())).sparkSession)
    sizes = {n: stored_bytes(df) for n, df in tables.items()}
    near = {n: df for n, df in tables.items() if sizes[n] <= most_bytes}
    counts = [
        df.select(F.lit(n).alias("t"), F.col(keys[n]).cast("string").alias("k")).groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"))
        for n, df in near.items()
    ]
    if not counts:
        return {}
    found = reduce(DataFrame.unionByName, counts).groupBy("t").agg(F.sum("n").alias("rows"), F.max(F.when(F.col("k").isNotNull(), F.col("n"))).alias("most")).collect()
    empty = {n: Measure(sizes[n], 0, True) for n in near}
    return empty | {r["t"]: Measure(sizes[r["t"]], r["rows"], r["most"] in (None, 1)) for r in found}  # a row per table


def small_tables(tables: Mapping[str, DataFrame], keys: Mapping[str, str], known: Mapping[str, Measure] | None = None) -> dict[str, bool]:
    """For each table: within the bounds, and unique on its key.  A measure
    that is ``known`` holds where the table's files still have its size."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    most_rows, most_bytes = max_broadcast_rows(spark), max_broadcast_bytes(spark)
    found = {n: m for n, m in (known or {}).items() if n in tables and m.size == stored_bytes(tables[n])}
    found |= measured({n: df for n, df in tables.items() if n not in found}, keys)
    return {n: n in found and found[n].size <= most_bytes and found[n].rows <= most_rows and found[n].unique for n in tables}
