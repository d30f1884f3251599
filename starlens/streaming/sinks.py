"""Sinks that keep more than rows: each event once (K4), partial states of the
analyses (K1), counts of field faults (K5).

All of it is written by stream and batch, in folders that a replayed batch
replaces, so a crash between any two of a batch's writes is mended by its
replay.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.functions.numeric import MONEY, pct
from starlens.functions.scope import Scope
from starlens.operators import dims
from starlens.operators.analyses import DEFAULT_TOP_N
from starlens.sources.schemas import KEYS, SCHEMAS
from starlens.sources.star import Star
from starlens.sources.versions import version_root
from starlens.streaming.fields import drift
from starlens.streaming.ingest import BATCH_COL, STREAM_COL, BatchSink

BUCKETS = 64
MAX_HINTED_KEYS = 500_000


class KeyedSink(BatchSink):
    """Stores an event once, however often and in whatever batch it is sent.

    Beside the table lies an index of its keys in ``buckets`` folders by hash.
    A batch's keys meet the index of their buckets only, and never the table;
    the index leaves out the batch's own entries, so that a replay finds what
    the first run found.  The batch's keys are broadcast into the index where
    they are few, so the index is not shuffled; the keys found are then left
    out.  Of events of one key in one batch the smallest row stays.  A table
    must have one such stream at a time."""

    def __init__(self, root: str, table: str, buckets: int = BUCKETS):
        super().__init__(root, table)
        self.buckets = buckets

    def index(self, spark: SparkSession) -> str:
        return f"{self.folder(spark)}/_keys/{self.table}"

    def known(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """(bucket, key) of all other batches."""
        schema = f"k string, bucket int, {STREAM_COL} string, {BATCH_COL} long"
        try:
            index = spark.read.schema(schema).parquet(self.index(spark))
        except Exception as e:
            if getattr(e, "getCondition", lambda: "")() != "PATH_NOT_FOUND":
                raise
            index = spark.createDataFrame([], schema)
        own = (F.col(STREAM_COL) == self.stream_id(spark)) & (F.col(BATCH_COL) == batch_id)
        return index.where(~own).select("bucket", "k")

    def fresh(self, good: DataFrame, batch_id: int) -> DataFrame:
        """The batch's events, one a key, that no other batch has stored."""
        key, spark = KEYS[self.table], good.sparkSession
        one = good.groupBy(key).agg(F.min(F.struct(*good.columns)).alias("x")).select("x.*")
        one = one.withColumns({"bucket": F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int"), "k": F.col(key)})
        keys = one.select("bucket", "k")
        few = keys.limit(MAX_HINTED_KEYS + 1).count() <= MAX_HINTED_KEYS
        seen = self.known(spark, batch_id).join(F.broadcast(keys) if few else keys, ["bucket", "k"], "left_semi")
        return one.join(seen, ["bucket", "k"], "left_anti")

    def store(self, good: DataFrame, batch_id: int) -> None:
        spark, held = good.sparkSession, good.persist()  # its keys and its rows are asked for, each decoded otherwise
        # Read back, so that rows and keys are of one and the same run.
        rows = self._own(spark, f"{self.folder(spark)}/{self.table}", batch_id)
        try:
            self.fresh(held, batch_id).select(*good.columns).write.mode("overwrite").parquet(rows)
        finally:
            held.unpersist()
        key = KEYS[self.table]
        kept = spark.read.schema(good.schema).parquet(rows).select(
            F.col(key).alias("k"), F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int").alias("bucket"))
        kept.withColumns({STREAM_COL: F.lit(self.stream_id(spark)), BATCH_COL: F.lit(batch_id)}).repartition("bucket").write.mode(
            "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", STREAM_COL, BATCH_COL).parquet(self.index(spark))


class FieldSink(BatchSink):
    """Takes events of ``decode_fields``: rejects with a reason, and counts of
    faults by field under ``_drift/<table>``.  The decode by field costs far
    more than a held row, so a batch is held for its outputs, of the raw text
    only what is rejected."""

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        held = batch.withColumn("_raw", F.when(~F.col("_ok"), F.col("_raw"))).persist()
        try:
            self.store_all(held, batch_id)
        finally:
            held.unpersist()

    def store_all(self, batch: DataFrame, batch_id: int) -> None:
        self.store(batch.where("_ok").select(*SCHEMAS[self.table].names), batch_id)
        bad = batch.where("NOT _ok").select(F.col("_raw").alias("value"), F.col("_reason").alias("reason"))
        if not bad.isEmpty():
            self._write(bad, self.rejects_path, batch_id)
        counts = drift(batch)
        if not counts.isEmpty():
            self._write(counts.coalesce(1), f"{self.root}/_drift/{self.table}", batch_id)


def _counted(*by: str) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def _revenue(rows: DataFrame) -> DataFrame:
    x = F.col("line_value")
    odd = F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.groupBy("sku_id").agg(F.sum(F.when(~odd, x).cast(MONEY)).alias("exact"), F.sum(F.when(odd, x)).alias("odd"))


# Table -> its partial states: sums and counts that add up over batches, and for
# what does not (distinct orders, joins of streams) the keys with their counts.
STATES: dict[str, dict[str, Callable[[DataFrame], DataFrame]]] = {
    "fact_payments": {"payments": _counted("method_id", "payment_status", "failure_reason")},
    "fact_order_headers": {"orders": _counted("order_id", "customer_id")},
    "fact_order_lines": {"revenue": _revenue, "lines": _counted("line_id", "sku_id")},
    "fact_shipments": {
        "couriers": _counted("courier_name"),
        "shipped": lambda rows: rows.groupBy("order_id").agg(F.count("shipment_id").alias("n"))},
    "fact_returns": {
        "reasons": _counted("return_reason"),
        "returned": lambda rows: rows.groupBy("line_id").agg(F.count("return_id").alias("n"))},
    "fact_inventory_transactions": {"stock": lambda rows: rows.groupBy("warehouse_id").agg(F.sum("quantity_change").alias("n"))},
    "fact_user_clickstream": {"clicks": _counted("device_type", "event_type")},
}


class StateSink(BatchSink):
    """Writes a batch's partial states beside its rows, under ``_states/<name>``.
    They are made from the rows as stored, so events are not decoded again for each."""

    def store(self, good: DataFrame, batch_id: int) -> None:
        super().store(good, batch_id)
        spark = good.sparkSession
        try:
            rows = spark.read.schema(good.schema).parquet(self._own(spark, f"{self.folder(spark)}/{self.table}", batch_id))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # a batch without good rows
                raise
            return
        for name, state in STATES.get(self.table, {}).items():
            self._write(state(rows), f"{self.folder(spark)}/_states/{name}", batch_id)


def read_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All batches' rows of a state; none where nothing is stored yet."""
    table = next(t for t, states in STATES.items() if name in states)
    schema = STATES[table][name](spark.createDataFrame([], SCHEMAS[table])).schema
    try:
        return spark.read.schema(schema).parquet(f"{version_root(spark, root)}/_states/{name}")
    except Exception as e:
        if getattr(e, "getCondition", lambda: "")() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def report_from_states(spark: SparkSession, root: str, top_n: int = DEFAULT_TOP_N) -> DataFrame:
    """(analysis, dimension, value): the unscoped ``report_long`` of the tables
    under ``root``, from the states of all batches and the dimensions as they
    are now.  No fact is read."""
    star, everything = Star.from_parquet(spark, root), Scope()
    star.check_dimensions()
    state = lambda name: read_state(spark, root, name)

    def long(analysis: str, groups: DataFrame, label: str, value) -> DataFrame:
        return groups.select(F.lit(analysis).alias("analysis"), F.col(label).cast("string").alias("dimension"), value.cast("double").alias("value"))

    n = F.sum("n").alias("n")
    payments, failed = state("payments").groupBy("method_id", "payment_status", "failure_reason").agg(n), F.col("payment_status") == "failed"
    methods = star.broadcast(star["dim_payment_methods"].select("method_id", "method_name"), "dim_payment_methods")
    by_method = payments.join(methods, "method_id").groupBy("method_name").agg(n, F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("failed"))
    by_reason = payments.where(failed & F.col("failure_reason").isNotNull()).groupBy("failure_reason").agg(n)

    # Counts of keys are multiplied and then added up, so they need no sum, and no shuffle, before the join.
    located = dims.by_customer_location(state("orders"), star, everything).select("order_id", "region_name", "n")
    by_region = located.groupBy("region_name").agg(F.count_distinct("order_id").alias("n"))
    shipped = state("shipped").groupBy("order_id").agg(F.sum("n").alias("s")).join(located, "order_id")
    shipped = shipped.groupBy("region_name").agg(F.sum(F.col("s") * F.col("n")).alias("n"))

    revenue = state("revenue").groupBy("sku_id").agg(F.sum("exact").alias("exact"), F.sum("odd").alias("odd"))
    revenue = revenue.join(dims.small_sku_category(star, everything), "sku_id").groupBy("category_name").agg(
        F.sum("exact").alias("exact"), F.sum("odd").alias("odd"))
    returned = state("returned").groupBy("line_id").agg(F.sum("n").alias("r"))
    skus = returned.join(state("lines"), "line_id").groupBy("sku_id").agg(F.sum(F.col("r") * F.col("n")).alias("n"))
    skus = skus.where("n > 0").orderBy(F.desc_nulls_first("n"), F.asc_nulls_last("sku_id")).limit(top_n)

    def simple(name: str, *by: str) -> DataFrame:
        return state(name).groupBy(*by).agg(n)

    parts = [
        long("payment_failure_by_method", by_method, "method_name", F.coalesce(pct("failed", "n"), F.lit(0))),
        long("payment_failure_by_reason", by_reason, "failure_reason", F.col("n")),
        long("orders_by_region", by_region, "region_name", F.col("n")),
        long("revenue_by_category", revenue, "category_name", F.coalesce("odd", F.round("exact", 2).cast("double"), F.lit(0.0))),
        long("courier_performance", simple("couriers", "courier_name"), "courier_name", F.col("n")),
        long("shipments_by_region", shipped, "region_name", F.col("n")),
        long("return_rate_by_sku", skus, "sku_id", F.col("n")),
        long("return_reasons", simple("reasons", "return_reason"), "return_reason", F.col("n")),
        long("inventory_by_warehouse", simple("stock", "warehouse_id"), "warehouse_id", F.col("n")),
        long("clickstream_by_device", simple("clicks", "device_type"), "device_type", F.col("n")),
        long("clickstream_funnel", simple("clicks", "event_type"), "event_type", F.col("n")),
    ]
    return reduce(DataFrame.unionByName, parts)
