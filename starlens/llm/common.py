"""Helpers shared by the operators: tables, lineage cuts, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a lineage cut
    that survives lost executors.  The folder is new for every call."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Smaller Arrow batches for the jobs run inside: less memory beside the heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)  # sets the checkpoint folder where the session has none
    return df.checkpoint()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph: ``edges`` (a, b) in,
    (node, component) out, the component named by its smallest node.

    Alternating large-star and small-star rounds; each round joins the edges
    with a per-node minimum (pre-aggregated, so that a hub costs one row a
    task, and written, so that the join is of plain shuffles, of which a hub
    is split) and is checkpointed.  Nodes without an edge are not returned; edges
    with a null end and loops are ignored.  No edge, row or label passes
    through the driver: only a count and a checksum of each round do.
    """
    e = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    e = e.where("lo < hi").dropna().distinct()
    e, state = checkpointed(e), None
    for _ in range(max_rounds):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == state:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
                e.select("lo", "lo").distinct())
        state = now
        ends = e.select(F.explode(F.array(
            F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")),
            F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))).alias("x")).select("x.u", "x.v")
        low = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        low = written(low, "components-low")
        large = ends.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        low = written(low, "components-lowest")
        small = large.join(low, "hi").select(
            F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                              F.struct(F.col("hi"), F.col("m").alias("lo")))).alias("x")).select("x.lo", "x.hi")
        e = checkpointed(small.where("lo < hi").distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
