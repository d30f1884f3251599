"""Ingest flows over the star views, end to end: recovery, all streams at once,
events sent twice, drifting fields, and the report kept up by batch."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.session import freed_shuffles, remove_folder, shared_dir
from starlens.sources.schemas import FACTS, KEYS, SCHEMAS, TOPICS
from starlens.sources.star import Star, stored_table
from starlens.sources.tables import truncate_all
from starlens.sources.versions import next_version
from starlens.streaming.fields import decode_fields
from starlens.streaming.ingest import BATCH_COL, BatchSink, _kept, decode, publish, publish_text, run_ingest, start_table
from starlens.streaming.sinks import FieldSink, KeyedSink, StateSink, report_from_states

# Facts are sent in so many parts that none has more events than this, two at least: it sizes a topic and drops nothing.
PART_EVENTS = 60_000_000


def _base(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


class _CrashAfter(BatchSink):
    """Stores batch ``at`` and then fails, as a driver lost between a batch's write and its commit."""

    def __init__(self, root: str, table: str, at: int):
        super().__init__(root, table)
        self.at = at

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        super().__call__(batch, batch_id)
        if batch_id == self.at:
            raise RuntimeError("lost before the commit")


def ingest_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(payment_id, batch_id): payments sent in three parts, a batch each.  The
    stream is lost after it has written batch 1 and before its commit; started
    again on its checkpoint it replays the batch from the offset log, meets an
    empty batch, and goes on with the next number."""
    base, table = _base(spark, "recovery"), "fact_payments"
    rows = Star.from_fixtures(spark, sf_dir)[table]
    third = F.pmod(F.col("order_id").cast("long"), F.lit(3))
    where = {"source": f"{base}/topics", "checkpoint_root": f"{base}/checkpoints", "available_now": True}
    publish(rows.where(third == 0), table, f"{base}/topics")
    run_ingest(spark, f"{base}/star", [table], **where)
    publish(rows.where(third == 1), table, f"{base}/topics")
    crashed = start_table(spark, table, f"{base}/star", sink_for=lambda t: _CrashAfter(f"{base}/star", t, 1), **where)
    try:
        crashed.awaitTermination()
        raise RuntimeError("the stream did not fail")
    except StreamingQueryException:
        pass
    spark.createDataFrame([], "value string").coalesce(1).write.mode("append").text(f"{base}/topics/{TOPICS[table]}")
    run_ingest(spark, f"{base}/star", [table], **where)
    publish(rows.where(third == 2), table, f"{base}/topics")
    run_ingest(spark, f"{base}/star", [table], **where)
    stored = stored_table(spark, f"{base}/star/{table}", table)
    return _kept(stored.select("payment_id", F.col(BATCH_COL).cast("long").alias("batch_id")), base)


def _published(spark: SparkSession, sf_dir: str, base: str, part: int | None = None, parts: int = 2) -> None:
    """All tables, or of each fact one ``part`` of ``parts``, the dimensions with the first."""
    star = Star.from_fixtures(spark, sf_dir)
    for table in FACTS if part else SCHEMAS:
        rows = star[table]
        if part is not None and table in FACTS:
            rows = rows.where(F.pmod(F.xxhash64(KEYS[table]), F.lit(parts)) == part)
        publish(rows, table, f"{base}/topics")


def ingest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table, rows): all fourteen streams at once, in one run, each in a scheduler pool of its own."""
    base = _base(spark, "all")
    _published(spark, sf_dir, base)
    run_ingest(spark, f"{base}/star", source=f"{base}/topics", checkpoint_root=f"{base}/checkpoints", available_now=True)
    star, counts = Star.from_parquet(spark, f"{base}/star"), None
    for table in SCHEMAS:
        one = star[table].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(table).alias("table"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return _kept(counts, base)


def ingest_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments sent again in later batches, and within one, and a batch
    replayed: the stored table, each key once."""
    base, table = _base(spark, "duplicates"), "fact_payments"
    rows = Star.from_fixtures(spark, sf_dir)[table]
    half = F.pmod(F.col("order_id").cast("long"), F.lit(2)) == 0
    for part in (rows.where(half).unionAll(rows.where(half)), rows, rows.where(~half)):
        publish(part, table, f"{base}/topics")
        run_ingest(spark, f"{base}/star", [table], source=f"{base}/topics", checkpoint_root=f"{base}/checkpoints", available_now=True,
                   sink_for=lambda t: KeyedSink(f"{base}/star", t))
    again = decode(spark.createDataFrame([], "value string").unionByName(
        rows.where(half).select(F.to_json(F.struct(*rows.columns)).alias("value"))), table)
    KeyedSink(f"{base}/star", table).bind(f"{base}/checkpoints/{table}")(again, 0)
    return _kept(stored_table(spark, f"{base}/star/{table}", table).select(*SCHEMAS[table].names), base)


def ingest_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of which some drift from their schema, told by quantity:
    (source, field, kind, n), faults counted by field, and rejects by reason."""
    base, table = _base(spark, "drift"), "fact_order_lines"
    lines = Star.from_fixtures(spark, sf_dir)[table]
    q = F.col("quantity")
    sent = lines.withColumns({"line_value": F.when(q != 13, F.col("line_value")), KEYS[table]: F.when(q != 1, F.col(KEYS[table])),
                              "note": F.when(q == 21, F.lit("sent by hand"))})
    event = F.to_json(F.struct(*sent.columns))
    event = (F.when(q > 45, F.concat(F.lit("cut "), F.coalesce("line_id", F.lit(""))))
             .when(q == 7, F.regexp_replace(event, '"quantity":7', '"quantity":"seven"'))
             .when(q == 30, F.regexp_replace(event, r'"line_value":([^,}]*)', '"line_value":"$1"')).otherwise(event))
    publish_text(sent.select(event.alias("value")), table, f"{base}/topics")
    run_ingest(spark, f"{base}/star", [table], source=f"{base}/topics", checkpoint_root=f"{base}/checkpoints", available_now=True,
               sink_for=lambda t: FieldSink(f"{base}/star", t), decoder=decode_fields)
    faults = spark.read.parquet(f"{base}/star/_drift/{table}").groupBy("field", "kind").agg(F.sum("n").alias("n"))
    rejects = spark.read.parquet(f"{base}/star/_rejects/{table}").groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    out = faults.select(F.lit("field").alias("source"), "field", "kind", "n").unionByName(
        rejects.select(F.lit("reject").alias("source"), F.lit(None).cast("string").alias("field"), "kind", "n"))
    return _kept(out, base)


def report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(analysis, dimension, value): the long report from the partial states of
    several batches a fact, one of them replayed.  A part's events are removed
    once they are stored, so the disk holds those of one part at a time."""
    base, table = _base(spark, "incremental"), "fact_shipments"
    star = Star.from_fixtures(spark, sf_dir)
    parts = max(2, -(-max(star[t].count() for t in FACTS) // PART_EVENTS))
    with freed_shuffles(spark):
        for part in range(parts):
            _published(spark, sf_dir, base, part, parts)
            run_ingest(spark, f"{base}/star", FACTS if part else None, source=f"{base}/topics", checkpoint_root=f"{base}/checkpoints",
                       available_now=True, sink_for=lambda t: StateSink(f"{base}/star", t))
            remove_folder(spark, f"{base}/topics")
        first = stored_table(spark, f"{base}/star/{table}", table).where(F.col(BATCH_COL) == 0).select(*SCHEMAS[table].names)
        publish(first, table, f"{base}/again")
        again = decode(spark.read.text(f"{base}/again/{TOPICS[table]}"), table)
        StateSink(f"{base}/star", table).bind(f"{base}/checkpoints/{table}")(again, 0)
        remove_folder(spark, f"{base}/again")
        return _kept(report_from_states(spark, f"{base}/star"), base)


def truncate_then_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(step, rows): payments stored by a stream before a truncation, after one
    that failed half-way, after a whole one, and after the stream went on."""
    base, table = _base(spark, "truncate"), "fact_payments"
    rows = Star.from_fixtures(spark, sf_dir)[table]
    half = F.pmod(F.col("order_id").cast("long"), F.lit(2)) == 0
    where = {"source": f"{base}/topics", "checkpoint_root": f"{base}/checkpoints", "available_now": True}
    publish(rows.where(half), table, f"{base}/topics")
    run_ingest(spark, f"{base}/star", [table], **where)
    steps: list[DataFrame] = []

    def count(step: str) -> None:
        now = Star.from_parquet(spark, f"{base}/star")[table]
        steps.append(now.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(step).alias("step"), "rows").checkpoint())

    count("stored")
    _, folder = next_version(spark, f"{base}/star")
    for name in list(SCHEMAS)[:7]:  # lost before the switch
        spark.createDataFrame([], SCHEMAS[name]).write.mode("overwrite").parquet(f"{folder}/{name}")
    count("half truncated")
    truncate_all(spark, f"{base}/star")
    count("truncated")
    publish(rows.where(~half), table, f"{base}/topics")
    run_ingest(spark, f"{base}/star", [table], **where)
    count("went on")
    return _kept(reduce(DataFrame.unionByName, steps), base)
