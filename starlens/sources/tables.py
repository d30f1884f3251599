"""Table maintenance and direct reads: recent rows and what belongs to them (A9), truncation (A10)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlens.functions.text import event_ts, short_label, ts_text
from starlens.sources.schemas import DIMENSIONS, FACTS, SCHEMAS
from starlens.sources.star import Star
from starlens.sources.versions import next_version, switch_version, version_root

DEFAULT_LIMIT = 20
MAX_LIMIT = 100
PUSHED = 10  # values of an IN that Spark hands to Parquet one by one


def recent_orders(star: Star, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The latest order headers by event time text, at most 100 (a top-k:
    Spark plans it as TakeOrderedAndProject, a per-partition top-k)."""
    if limit < 0:
        raise ValueError("limit must not be negative")
    return (
        star["fact_order_headers"]
        .orderBy(F.desc_nulls_first("event_timestamp"), F.asc_nulls_last("order_id"))
        .limit(min(limit, MAX_LIMIT))
    )


def recent_orders_labelled(star: Star, limit: int = MAX_LIMIT) -> DataFrame:
    """The latest orders as a list for display: rank, short label of the id
    (H9), and the event time parsed and its date (H14)."""
    latest = Window.orderBy(F.desc_nulls_first("event_timestamp"), F.asc_nulls_last("order_id"))  # at most 100 rows
    when = event_ts(F.col("event_timestamp"))
    return recent_orders(star, limit).select(
        F.row_number().over(latest).alias("rank"), short_label(F.col("order_id"), 4).alias("label"),
        F.substring(ts_text(when), 1, 19).alias("at"), F.to_date(when).cast("string").alias("day"))


def rows_of(rows: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """The rows of a stored table whose ``key`` is one of ``values``, few
    enough for a plan.  Spark hands an IN of more than ``PUSHED`` values to
    Parquet as one range, so more are asked in groups."""
    values = sorted({v for v in values if v is not None})
    groups = [F.col(key).isin(values[k:k + PUSHED]) for k in range(0, len(values), PUSHED)]
    return rows.where(reduce(lambda a, b: a | b, groups) if groups else F.lit(False))


def recent_order_facts(star: Star, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """(order_id, event_timestamp, lines, quantity, payments, failed,
    shipments) of the latest orders.  Their ids, at most 100, are looked up in
    the facts (``rows_of``), which on the layout reads the buckets of the ids
    and of each bucket at most a page an id.  An order without rows of a fact has 0 of them; a null
    order id meets none."""
    latest = recent_orders(star, limit).select("order_id", "event_timestamp")
    found = latest.collect()  # at most 100 rows
    ids, n = [r["order_id"] for r in found], F.count(F.lit(1))
    facts = [
        rows_of(star["fact_order_lines"], "order_id", ids).groupBy("order_id").agg(n.alias("lines"), F.sum("quantity").alias("quantity")),
        rows_of(star["fact_payments"], "order_id", ids).groupBy("order_id").agg(
            n.alias("payments"), F.count_if(F.col("payment_status") == "failed").alias("failed")),
        rows_of(star["fact_shipments"], "order_id", ids).groupBy("order_id").agg(n.alias("shipments")),
    ]
    out = star.spark.createDataFrame(found, latest.schema)
    for fact in facts:
        out = out.join(fact, "order_id", "left")
    return out.fillna(0, ["lines", "quantity", "payments", "failed", "shipments"])


def create_tables(spark: SparkSession, root: str) -> list[str]:
    """The fourteen parquet tables under ``root``, empty where they do not
    exist yet; existing ones are left alone.  Returns the names created."""
    root, created = version_root(spark, root), []
    for name in DIMENSIONS + FACTS:
        try:
            spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            spark.createDataFrame([], SCHEMAS[name]).write.mode("ignore").parquet(f"{root}/{name}")
            created.append(name)
    return created


def create_tables_jdbc(spark: SparkSession, url: str, properties: dict[str, str]) -> None:
    """As ``create_tables`` in a database (existing tables are left alone)."""
    for name in DIMENSIONS + FACTS:
        spark.createDataFrame([], SCHEMAS[name]).write.mode("ignore").jdbc(url, name, properties=properties)


def truncate_all(spark: SparkSession, root: str) -> list[str]:
    """Empty the fourteen parquet star tables under ``root`` in one step: a new
    version of all of them is written empty and then switched to.  A failure
    before the switch leaves the old tables as they are.  Streams go on in the
    new version with their next batch; their checkpoints are left alone, so old
    events are not ingested again.  Folders of old versions stay for readers
    that began before."""
    number, folder = next_version(spark, root)
    for name in FACTS + DIMENSIONS:
        spark.createDataFrame([], SCHEMAS[name]).write.mode("overwrite").parquet(f"{folder}/{name}")
    switch_version(spark, root, number)
    return FACTS + DIMENSIONS


def truncate_all_jdbc(spark: SparkSession, url: str, properties: dict[str, str]) -> list[str]:
    """As ``truncate_all`` for tables in a database (``TRUNCATE`` keeps the
    table definitions)."""
    for name in FACTS + DIMENSIONS:
        (
            spark.createDataFrame([], SCHEMAS[name])
            .write.mode("overwrite")
            .option("truncate", "true")
            .jdbc(url, name, properties=properties)
        )
    return FACTS + DIMENSIONS
