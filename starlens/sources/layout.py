"""Storage layout for the star at scale: bucketed catalog tables.

The analyses join facts to order headers on ``order_id`` (payments,
shipments, lines) and lines to returns on ``line_id``.  Written with
``bucketBy(n, key).sortBy(key)``, these joins read both sides already
hash-partitioned on the key and sorted by it, so Spark plans them without an
exchange and without a sort.  Facts that are joined on few or nullable values,
the inventory on its warehouse and the clicks on their customer, are not
bucketed: a hot warehouse or customer would be one task, while a plain table
aggregates map-side first and lets AQE split a skewed join.

Rows are repartitioned by their bucket before a bucketed write, so that a version
has one file a bucket and not one for each task and bucket.  Spark relies on
the order only where a bucket is one file; appended micro-batches add files,
and ``compact_ingested`` merges them into a new version beyond ``MAX_FILES`` a
bucket.  ``compact`` writes a whole new version of every table under names of
its own, checks row counts, and then switches the views that readers use; a
failed run leaves the old version readable.  ``compact_ingested`` appends only
the micro-batches that the layout does not hold yet.

Few keys are found by ``tables.rows_of``: buckets are pruned by the key's hash, row
groups and pages by the order of the rows, and row groups by Parquet Bloom
filters on a fact's own key, which is not the one it is sorted by.

What decides whether a dimension may be broadcast, its rows and whether its
key is unique, is counted when a version is written or appended to, and kept
with the view that readers use together with the size of the files it was
counted over; it holds only while the files have that size.

The bucket count should give buckets of a few hundred MB for the largest
fact and stays fixed for the tables' life (both sides of a join need the
same count to avoid a shuffle).
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.operators.questions import refresh_vocabulary
from starlens.plans.joins import measured
from starlens.session import remove_folder, shared_dir
from starlens.sources.schemas import DIMENSIONS, KEYS, SCHEMAS
from starlens.sources.star import NOTE, Star, stored_table
from starlens.sources.versions import version_root

# The join key each fact is bucketed on.
BUCKET_KEYS = {
    "fact_order_headers": "order_id",
    "fact_payments": "order_id",
    "fact_shipments": "order_id",
    "fact_order_lines": "order_id",
    "fact_returns": "line_id",
}
# Each Bloom filter takes the smallest of these sizes that holds a row group's keys: BLOOM_BYTES, a half, a quarter...
BLOOM_BYTES, BLOOM_SIZES = 4 * 1024 * 1024, 6
MIN_BUCKETS, BUCKET_ROWS = 8, 1_000_000  # of a layout whose bucket count is not given: the fewest, and rows in each
MAX_FILES = 16  # files a bucket may have before its table is merged
BATCH = ["stream_id", "batch_id"]
FIRST = "compacted"  # stands for the stream of rows that did not come from a micro-batch


def _with_batch(df: DataFrame, name: str) -> DataFrame:
    """The table's columns and those that tell its micro-batch."""
    has = set(df.columns)
    stream = F.col("stream_id") if "stream_id" in has else F.lit(FIRST)
    batch = F.col("batch_id").cast("long") if "batch_id" in has else F.lit(0).cast("long")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name].fields],
                     F.coalesce(stream.cast("string"), F.lit(FIRST)).alias("stream_id"), batch.alias("batch_id"))


def _write(df: DataFrame, name: str, table: str, buckets: int, mode: str) -> None:
    key = BUCKET_KEYS.get(name)
    if key:
        blooms = {f"parquet.bloom.filter.enabled#{KEYS[name]}": "true"} if KEYS[name] != key else {}
        blooms |= {"parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.max.bytes": str(BLOOM_BYTES),
                   "parquet.bloom.filter.candidates.number": str(BLOOM_SIZES)}
        # By the bucket's own number: Spark drops a repartition by the key of a table that has these buckets
        # already, reads it without them, and so would write a bucket from several tasks.
        rows = df.repartitionById(buckets, F.pmod(F.hash(key), F.lit(buckets))).write.mode(mode).format("parquet").options(**blooms)
        rows.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    else:
        df.write.mode(mode).format("parquet").saveAsTable(table)


def _database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location.rstrip('/')}/{database}.db'")


def versions(spark: SparkSession, database: str, name: str) -> list[str]:
    """The written versions of a table, oldest first."""
    found = [t.name for t in spark.catalog.listTables(database) if t.name.startswith(f"{name}__v")]
    return sorted(found, key=lambda t: int(t.rsplit("__v", 1)[1].split("_")[0]))


def _switch(spark: SparkSession, database: str, new: dict[str, str]) -> None:
    noted = measured({n: spark.table(f"{database}.{t}") for n, t in new.items() if n in DIMENSIONS}, KEYS)
    for name, table in new.items():
        note = f"TBLPROPERTIES ('{NOTE}' = '{noted[name].note()}')" if name in noted else ""
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} {note} AS SELECT * FROM {database}.{table}")


def compact(star: Star, database: str, location: str, buckets: int, keep_versions: int = 2, names: Iterable[str] = SCHEMAS) -> list[str]:
    """Write every table of ``star``, or those named, as a new version in ``database`` (created
    at ``location`` if needed) and switch to it; of older versions the newest
    ``keep_versions - 1`` stay, for readers that began before the switch."""
    tables = {name: _with_batch(star[name], name) for name in names}
    return _compact(star.spark, tables, database, location, buckets, keep_versions)


def _compact(spark: SparkSession, tables: dict[str, DataFrame], database: str, location: str, buckets: int, keep_versions: int) -> list[str]:
    _database(spark, database, location)
    new = {}
    for name, df in tables.items():
        old = versions(spark, database, name)
        number = 1 + max([0, *(int(t.rsplit("__v", 1)[1].split("_")[0]) for t in old)])
        new[name] = f"{name}__v{number}_{uuid.uuid4().hex[:6]}"
        _write(df, name, f"{database}.{new[name]}", buckets, "errorifexists")
    for name, df in tables.items():
        there, here = df.count(), spark.table(f"{database}.{new[name]}").count()
        if there != here:
            raise RuntimeError(f"{name}: wrote {here} of {there} rows; the old version stays in use")
    _switch(spark, database, new)
    for name in tables:
        for t in versions(spark, database, name)[:-keep_versions]:
            spark.sql(f"DROP TABLE {database}.{t}")
    return [f"{database}.{name}" for name in tables]


def _files_a_bucket(spark: SparkSession, table: str) -> int:
    """The most files that a bucket of the table has."""
    return max(Counter(f.rsplit("_", 1)[-1] for f in spark.table(table).inputFiles()).values(), default=0)


def _new_batches(stored: DataFrame, held: DataFrame) -> DataFrame:
    """The stored micro-batches that ``held`` lacks.  Batch ids of a stream
    only grow, so one number a stream tells; they become partition filters."""
    last = held.groupBy("stream_id").agg(F.max("batch_id").alias("last")).collect()  # a row per stream
    known = [(F.col("stream_id") == r["stream_id"]) & (F.col("batch_id") <= r["last"]) for r in last]
    return stored.where(~reduce(lambda a, b: a | b, known)) if known else stored


def compact_ingested(spark: SparkSession, ingest_root: str, database: str, location: str, buckets: int,
                     dedupe: bool = False, vocabulary: str | None = None, max_files: int = MAX_FILES) -> Star:
    """Bring the layout up to the ingest's tables under ``ingest_root`` and
    return the star read from it (a periodic batch job next to the streams).

    Micro-batches that the layout does not hold yet are appended, a file a
    bucket; a bucketed table with more than ``max_files`` in one is written
    anew, sorted, as a version of its own.  With ``dedupe`` a whole new version is written instead, with one
    row per key: the one of the first stream and batch.  With ``vocabulary``
    the scope vocabulary of the questions is refreshed under that path."""
    root = version_root(spark, ingest_root)
    stored = {n: _with_batch(stored_table(spark, f"{root}/{n}", n), n) for n in SCHEMAS}
    _database(spark, database, location)
    if dedupe:
        _compact(spark, {n: _one_per_key(df, n) for n, df in stored.items()}, database, location, buckets, 2)
    elif any(not versions(spark, database, n) for n in SCHEMAS):
        _compact(spark, stored, database, location, buckets, 2)
    else:
        for n, df in stored.items():
            current = f"{database}.{versions(spark, database, n)[-1]}"
            new = _new_batches(df, spark.table(current))
            if not new.isEmpty():
                _write(new, n, current, buckets, "append")
                spark.catalog.refreshTable(current)
                _switch(spark, database, {n: current.split(".")[1]})
            if n in BUCKET_KEYS and _files_a_bucket(spark, current) > max_files:
                _compact(spark, {n: spark.table(current)}, database, location, buckets, 2)
    star = Star.from_catalog(spark, database)
    if vocabulary:
        refresh_vocabulary(star, vocabulary)
    return star


def _one_per_key(df: DataFrame, name: str) -> DataFrame:
    """Rows without a key stay; of those that share one, the smallest (stream, batch, row)."""
    key = KEYS[name]
    first = F.min(F.struct(*BATCH, *[c for c in df.columns if c not in BATCH])).alias("row")
    keyed = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(first).select("row.*")
    return keyed.select(*df.columns).unionByName(df.where(F.col(key).isNull()))


def buckets_for(star: Star, names: Iterable[str]) -> int:
    """A bucket count for a layout of the named tables, by the rows of the
    largest, as the task that writes or reads a bucket has all of it."""
    rows = max((star[n].count() for n in names if n in BUCKET_KEYS), default=0)
    return max(MIN_BUCKETS, -(-rows // BUCKET_ROWS))


def on_layout(star: Star, query: Callable[[Star], DataFrame], names: Iterable[str], buckets: int | None = None) -> DataFrame:
    """``query`` over a layout of the tables it reads, written for it alone in the shared folder and removed again.
    Without ``buckets`` their number grows with the tables."""
    spark, name, names = star.spark, f"layout_{uuid.uuid4().hex}", list(names)
    buckets = buckets or buckets_for(star, names)
    where = f"{shared_dir(spark)}/{name}"
    compact(star, name, where, buckets, names=names)
    out = query(Star.from_catalog(spark, name)).checkpoint()
    spark.sql(f"DROP DATABASE {name} CASCADE")
    remove_folder(spark, where)
    return out
