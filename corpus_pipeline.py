"""The corpus pipeline: quality, line chunks, near duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``.  The driver, or ``run``, writes each
stage's result as Parquet and reads it as the next stage's ``docs``.

A very long text is one row in every stage and is read, hashed, mixed and
encoded whole, never cut.

SQL cannot express the quality classifier (a fitted model), the SimHash stage
or the encoding, so ``ORACLE_SQL`` is None; tests/llm hold the pipeline
against a brute-force version of every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlens.llm import bpe, linechunks, mixing, quality, simhash
from starlens.llm.common import table, written

VOCABULARY = "word_bpe_49k.json"


def _columns(docs: DataFrame, struct: str, **new: Column) -> list[Column]:
    """The columns of ``docs`` out of a struct of them, some replaced."""
    return [(new[c] if c in new else F.col(struct).getField(c)).alias(c) for c in docs.columns]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.  It is fitted on
    labelled documents among those given; a null or empty text is scored as an
    empty line.  Rows are scored one by one, so repeated ids change nothing."""
    field = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, field, docs.columns)
    return scored.where(F.col("score") >= quality.CUT).select(_columns(docs, "kept"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; n_chars follows the text.  A
    document all of whose lines go keeps its row with an empty text."""
    out = linechunks.dedup_line_chunks(docs)
    return out.select(_columns(docs, "row", text=F.col("text"), n_chars=F.length("text").cast("long")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id's (null
    ids last), of its texts the smallest hash.  Texts without a word all have
    fingerprint zero and so are one group."""
    groups = simhash.near_duplicates(docs)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "h")).alias("first"))
    first = first.select(F.col("first.id").alias("id"), F.col("first.h").alias("h"))
    again = groups.groupBy("id", "h").agg(F.count("*").alias("n")).where("n > 1").withColumnsRenamed({"id": "id_", "h": "h_"})
    first = first.join(again, F.col("id").eqNullSafe(F.col("id_")) & (F.col("h") == F.col("h_")), "left").drop("id_", "h_")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id_"), F.xxhash64("text").alias("h_"))
    met = rows.join(first, F.col("id").eqNullSafe(F.col("id_")) & (F.col("h") == F.col("h_"))).drop("id_", "h_")
    # Only rows that repeat id and text need one of them to be chosen.
    place = F.row_number().over(Window.partitionBy("id", "h").orderBy("row"))
    one = met.where("n IS NULL").unionByName(met.where("n IS NOT NULL").withColumn("k", place).where("k = 1").drop("k"))
    return one.select(_columns(docs, "row"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus at its target weights: every document at least once, those
    of small sources up to twice, in the order of the block permutations."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every reading."""
    out = bpe.encode_digests(docs, public_tokenizers.path(VOCABULARY))
    return out.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", one_of_each_group),
    ("mixing sources", mix_sources),
    ("BPE encoding", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
