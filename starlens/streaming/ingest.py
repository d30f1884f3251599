"""Event ingest with Structured Streaming.

One streaming query per star table: read the table's topic (``kafka`` in
production, a folder of JSON-lines files in tests) in micro-batches of a
bounded size, decode each event with the table's fixed schema, and write every
micro-batch through ``foreachBatch``:

* good rows go to the table, under ``stream_id=<id>/batch_id=<n>`` with
  dynamic partition overwrite.  The stream's id is the one that Spark keeps in
  its checkpoint, so a micro-batch replayed after a failure replaces its own
  earlier output, and no other stream's: a new or lost checkpoint, or a second
  job on the same sink, only ever adds rows (K4);
* rows that do not decode, or lack their key, go to ``_rejects/<table>`` in
  the same way, with the raw text (K5);
* empty batches store nothing (K2).

The tables are created empty before the streams start, so every reader finds
all fourteen.  Checkpoints live under the shared folder named by
``spark.checkpoint.dir`` so a restarted job resumes where it stopped (K3).
Events that a producer sent twice are told apart by key when the tables are
compacted (``sources.layout``), not for each batch.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starlens.session import remove_folder, shared_dir
from starlens.sources.schemas import KEYS, SCHEMAS, TOPICS
from starlens.sources.star import key_ranges, stored_table
from starlens.sources.tables import create_tables
from starlens.sources.versions import version_root

STREAM_COL, BATCH_COL = "stream_id", "batch_id"
# Bounds of one micro-batch: they size batches and drop nothing.
MAX_FILES, MAX_OFFSETS = 1000, 5_000_000
POOL = "spark.scheduler.pool"
# Files of a folder topic: compressed, so each is read by one task, and cut to keep that task small.
FILE_CODEC, FILE_EVENTS = "lz4", 500_000
STORED_CODEC = "zstd"  # of what a batch stores: keys as text, about a third smaller than Spark's default


def decode(raw: DataFrame, table: str) -> DataFrame:
    """(``value`` as text, decoded struct) -> table columns plus ``_raw`` and
    ``_ok`` (decoded and keyed)."""
    schema = SCHEMAS[table]
    text = F.col("value").cast("string")
    parsed = raw.select(text.alias("_raw"), F.from_json(text, schema).alias("_data"))
    key = KEYS[table]
    return parsed.select(
        *[F.col("_data").getField(f.name).alias(f.name) for f in schema.fields],
        "_raw",
        (F.col("_data").isNotNull() & F.col("_data").getField(key).isNotNull()).alias("_ok"),
    )


class BatchSink:
    """``foreachBatch`` writer of one table into parquet under ``root``.

    The stream's id is read from its checkpoint (``bind``); a sink that is not
    bound to one has an id of its own, so it never overwrites another's rows.
    """

    def __init__(self, root: str, table: str):
        self.root = root.rstrip("/")
        self.table = table
        self.checkpoint: str | None = None
        self._stream_id: str | None = None

    def folder(self, spark: SparkSession) -> str:
        """Where the current version of the tables lies."""
        return version_root(spark, self.root)

    @property
    def rejects_path(self) -> str:
        return f"{self.root}/_rejects/{self.table}"

    def bind(self, checkpoint: str) -> "BatchSink":
        self.checkpoint = checkpoint
        return self

    def stream_id(self, spark: SparkSession) -> str:
        if self._stream_id is None:
            if self.checkpoint:  # Spark writes its id there before the first batch
                self._stream_id = json.loads(spark.read.text(f"{self.checkpoint}/metadata").first()[0])["id"]
            else:
                self._stream_id = uuid.uuid4().hex
        return self._stream_id

    def _own(self, spark: SparkSession, path: str, batch_id: int) -> str:
        """The batch's folder under ``path``."""
        return f"{path}/{STREAM_COL}={self.stream_id(spark)}/{BATCH_COL}={batch_id}"

    def _write(self, df: DataFrame, path: str, batch_id: int) -> None:
        (
            df.withColumns({STREAM_COL: F.lit(self.stream_id(df.sparkSession)), BATCH_COL: F.lit(batch_id)})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", STORED_CODEC)
            .partitionBy(STREAM_COL, BATCH_COL)
            .parquet(path)
        )

    def store(self, good: DataFrame, batch_id: int) -> None:
        self._write(good, f"{self.folder(good.sparkSession)}/{self.table}", batch_id)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # A batch is bounded, so decoding it once for each output is cheaper than holding it.
        self.store(batch.where("_ok").select(*SCHEMAS[self.table].names), batch_id)
        bad = batch.where(~F.col("_ok")).select(F.col("_raw").alias("value"))
        if not bad.isEmpty():
            self._write(bad, self.rejects_path, batch_id)


class JdbcBatchSink(BatchSink):
    """A5: ``foreachBatch`` append of one table into a database table.

    An append has no partition to overwrite, but only the first batch after a
    start can be a replay: Spark moves on once a batch is committed.  With
    ``check_replay`` (default) that one batch is stored without the keys that
    the table already holds, read in key ranges over ``partitions``
    connections; all later batches are plain appends.  Rejects go to parquet
    under ``rejects_root``.
    """

    def __init__(self, url: str, table: str, properties: Mapping[str, str], rejects_root: str,
                 check_replay: bool = True, batch_size: int = 10_000, partitions: int = 16):
        super().__init__(rejects_root, table)
        self.url = url
        self.properties = dict(properties)
        self.check_replay = check_replay
        self.batch_size = batch_size
        self.partitions = partitions
        self._started = False

    def stored_keys(self, spark: SparkSession) -> DataFrame:
        key = KEYS[self.table]
        return spark.read.jdbc(self.url, self.table, predicates=key_ranges(key, self.partitions), properties=self.properties).select(key)

    def append(self, good: DataFrame) -> None:
        good.write.mode("append").option("batchsize", str(self.batch_size)).jdbc(self.url, self.table, properties=self.properties)

    def store(self, good: DataFrame, batch_id: int) -> None:
        if self.check_replay and not self._started:
            good = good.join(self.stored_keys(good.sparkSession), KEYS[self.table], "left_anti")
        self.append(good)
        self._started = True


def read_topic(spark: SparkSession, table: str, fmt: str = "text", source: str | None = None,
               options: Mapping[str, str] | None = None, max_files: int = MAX_FILES,
               max_offsets: int = MAX_OFFSETS) -> DataFrame:
    """A1: the raw event stream of ``table`` (single ``value`` column), in
    micro-batches of at most ``max_files`` files or ``max_offsets`` offsets."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("maxOffsetsPerTrigger", max_offsets).options(**dict(options or {}))
        return reader.option("subscribe", TOPICS[table]).option("startingOffsets", "earliest").load()
    reader = reader.option("maxFilesPerTrigger", max_files).options(**dict(options or {}))
    return reader.load(f"{source.rstrip('/')}/{TOPICS[table]}")


def start_table(spark: SparkSession, table: str, sink_root: str, fmt: str = "text", source: str | None = None,
                options: Mapping[str, str] | None = None, checkpoint_root: str | None = None,
                available_now: bool = False, processing_time: str = "5 seconds",
                sink_for: Callable[[str], BatchSink] | None = None, max_files: int = MAX_FILES,
                max_offsets: int = MAX_OFFSETS, decoder: Callable[[DataFrame, str], DataFrame] = decode) -> StreamingQuery:
    """K1: one table's ingest query.  The sink defaults to parquet tables
    under ``sink_root``, created first; ``sink_for`` makes another one for the
    table, such as ``lambda t: JdbcBatchSink(url, t, properties, root)``, and
    ``decoder`` another decode, such as ``fields.decode_fields``.  The stream's
    jobs run in a scheduler pool of the table's, so that with
    ``spark.scheduler.mode=FAIR`` a large batch of one delays no other."""
    ckpt = f"{(checkpoint_root or f'{shared_dir(spark)}/ingest-checkpoints').rstrip('/')}/{table}"
    if sink_for is None:
        create_tables(spark, sink_root)
    sink = (sink_for(table) if sink_for else BatchSink(sink_root, table)).bind(ckpt)
    stream = decoder(read_topic(spark, table, fmt, source, options, max_files, max_offsets), table)
    writer = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", ckpt)
        .queryName(f"ingest_{table}_{uuid.uuid4().hex[:8]}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    sc = spark.sparkContext
    before = sc.getLocalProperty(POOL)
    sc.setLocalProperty(POOL, f"ingest_{table}")  # the stream's thread inherits it
    try:
        return writer.start()
    finally:
        sc.setLocalProperty(POOL, before)


def start_all(spark: SparkSession, sink_root: str, tables: Iterable[str] | None = None, **kw) -> list[StreamingQuery]:
    """One query per table, each with a sink of its own; wait with
    ``spark.streams.awaitAnyTermination()``."""
    return [start_table(spark, t, sink_root, **kw) for t in (tables or SCHEMAS)]


def run_ingest(spark: SparkSession, sink_root: str, tables: Iterable[str] | None = None,
               timeout_s: float | None = None, **kw) -> list[StreamingQuery]:
    """Start one query per table and wait until any of them ends (or
    ``timeout_s`` seconds pass); then stop the others, so one failed stream
    ends the job and the cluster manager can restart it from the checkpoints.
    With ``available_now`` (a backfill) every stream is awaited instead, and a
    backfill that is not done in time raises ``TimeoutError``; what it has
    stored stays, and a rerun goes on from the checkpoints.  The first failure
    of a stream, if any, is raised."""
    queries = start_all(spark, sink_root, tables, **kw)
    late: list[str] = []
    try:
        if kw.get("available_now"):
            end = None if timeout_s is None else time.monotonic() + timeout_s
            # Any stream's failure ends the wait for all.
            while any(q.isActive for q in queries) and all(q.exception() is None for q in queries):
                if end is not None and time.monotonic() >= end:
                    late = [q.name for q in queries if q.isActive]
                    break
                time.sleep(0.05)
        elif timeout_s is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(timeout_s)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
        spark.streams.resetTerminated()
    failed = [q.exception() for q in queries if q.exception() is not None]
    if failed:
        raise RuntimeError(str(failed[0]))
    if late:
        raise TimeoutError(f"not done within {timeout_s} s: {', '.join(late)}")
    return queries


def publish(df: DataFrame, table: str, target: str, fmt: str = "text",
            options: Mapping[str, str] | None = None) -> None:
    """Write rows as one JSON object per event (null fields omitted)."""
    publish_text(df.select(F.to_json(F.struct(*df.columns)).alias("value")), table, target, fmt, options)


def publish_text(events: DataFrame, table: str, target: str, fmt: str = "text",
                 options: Mapping[str, str] | None = None) -> None:
    """Raw events (a ``value`` column) onto the table's topic."""
    if fmt == "kafka":
        events.write.format("kafka").options(**dict(options or {})).option("topic", TOPICS[table]).save()
    else:
        files = events.write.mode("append").option("compression", FILE_CODEC).option("maxRecordsPerFile", FILE_EVENTS)
        files.options(**dict(options or {})).text(f"{target.rstrip('/')}/{TOPICS[table]}")


def _kept(df: DataFrame, base: str) -> DataFrame:
    """``df`` checkpointed, its source folder removed."""
    out = df.checkpoint()
    remove_folder(df.sparkSession, base)
    return out


def ingest_roundtrip(spark: SparkSession, sf_dir: str, table: str, files: int | None = None, max_files: int = MAX_FILES) -> DataFrame:
    """Publish a fixture star table as JSON events (in ``files`` files), ingest
    it with a streaming query, and read the stored table back."""
    from starlens.sources.star import Star

    base = f"{shared_dir(spark)}/roundtrip-{uuid.uuid4().hex}"
    rows = Star.from_fixtures(spark, sf_dir)[table]
    publish(rows.repartition(files) if files else rows, table, f"{base}/topics")
    run_ingest(spark, f"{base}/star", [table], source=f"{base}/topics", checkpoint_root=f"{base}/checkpoints",
               available_now=True, max_files=max_files)
    stored = stored_table(spark, f"{base}/star/{table}", table)
    cols = SCHEMAS[table].names
    return _kept(stored.select(*cols, BATCH_COL) if files else stored.select(*cols), base)


def ingest_replay(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Two streams with checkpoints of their own feed one sink, half of the
    events each; the first stream's batch is then replayed, as after a crash
    between its write and its commit.  The stored table: every event once."""
    from starlens.sources.star import Star

    base = f"{shared_dir(spark)}/replay-{uuid.uuid4().hex}"
    rows = Star.from_fixtures(spark, sf_dir)[table]
    half = F.pmod(F.xxhash64(KEYS[table]), F.lit(2))
    for k in (0, 1):
        publish(rows.where(half == k), table, f"{base}/topics{k}")
        run_ingest(spark, f"{base}/star", [table], source=f"{base}/topics{k}", checkpoint_root=f"{base}/checkpoints{k}", available_now=True)
    again = decode(spark.read.text(f"{base}/topics0/{TOPICS[table]}"), table)
    BatchSink(f"{base}/star", table).bind(f"{base}/checkpoints0/{table}")(again, 0)
    return _kept(stored_table(spark, f"{base}/star/{table}", table).select(*SCHEMAS[table].names), base)


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of which some events are cut short (quantity over 45) and
    some lack their key (quantity 1): (kind, value), the keys stored and the
    raw text of the rejects."""
    from starlens.sources.star import Star

    base, table = f"{shared_dir(spark)}/rejects-{uuid.uuid4().hex}", "fact_order_lines"
    lines = Star.from_fixtures(spark, sf_dir)[table]
    whole = F.to_json(F.struct(*[F.when(F.col("quantity") != 1, F.col(c)).alias(c) if c == KEYS[table] else F.col(c) for c in lines.columns]))
    event = F.when(F.col("quantity") > 45, F.concat(F.lit("cut "), F.col("line_id"))).otherwise(whole)
    publish_text(lines.select(event.alias("value")), table, f"{base}/topics")
    run_ingest(spark, f"{base}/star", [table], source=f"{base}/topics", checkpoint_root=f"{base}/checkpoints", available_now=True)
    stored = stored_table(spark, f"{base}/star/{table}", table).select(F.lit("stored").alias("kind"), F.col("line_id").alias("value"))
    bad = spark.read.parquet(f"{base}/star/_rejects/{table}")
    keyless = F.get_json_object("value", "$.order_id")
    bad = bad.select(F.lit("reject").alias("kind"), F.coalesce(F.concat(F.lit("no key, order "), keyless), F.col("value")).alias("value"))
    return _kept(stored.unionByName(bad), base)
