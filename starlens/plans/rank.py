"""Ranks over a whole breakdown without a single task (G1).

The rows are range-partitioned by their order and sorted within partitions; a
row's rank is its place in its partition plus the number of rows in those
before, of which there is one number a partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.session import shared_dir

_PLACE = (1 << 33) - 1  # monotonically_increasing_id is the partition's number times 2^33 plus the place in it


def with_rank(rows: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their rank from 1 in a total ``order``.  The sorted rows
    are checkpointed, so that places and counts are of one and the same run;
    rows that the order leaves equal are ranked in some order."""
    shared_dir(rows.sparkSession)
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit(_PLACE))
    sizes = placed.groupBy(part.alias("part")).agg((F.max(place) + 1).alias("n")).select(F.collect_list(F.struct("part", "n")).alias("sizes")).scalar()
    before = F.aggregate(F.filter("_sizes", lambda s: s["part"] < part), F.lit(0).cast("long"), lambda a, s: a + s["n"])
    return placed.withColumn("_sizes", sizes).withColumn(name, (before + place + 1).cast("int")).drop("_at", "_sizes")
