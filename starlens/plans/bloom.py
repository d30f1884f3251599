"""Semi-join reduction by a Bloom filter, applied before a large side is shuffled.

``might_join`` keeps the rows of a large table whose key may occur among the
keys of a smaller one, and drops nearly all others.  The filter is a table of
blocks of ``WORDS`` 64-bit words, built by aggregation: a key sets ``HASHED``
bits of one word, and words are or-ed map-side first, so repeated and hot keys
cost one row a task.  Blocks are broadcast and met by an equi-join on the
block's number, a left semi-join whose condition tests the key's bits.  No key
is lost, so a join that follows gives the same rows with or without it.

The filter has ``BITS_PER_KEY`` bits for each row of the smaller side, which
one count tells.  The large side is returned as it is where a filter would not
pay: where its files are under ``starlens.bloom.minBytes`` (1 GB), where Spark
broadcasts the keys by their size and shuffles no large side at all, and where
the filter is more than ``starlens.broadcast.maxBytes`` (32 MB: 16 million keys).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.plans.joins import max_broadcast_bytes, planned_bytes, stored_bytes

WORDS = 64  # of a block
HASHED = 4  # bits of a key, all in one word
BITS_PER_KEY = 16
MIN_KEY, MIN_BYTES = "starlens.bloom.minBytes", 1024**3


def _places(key: str, blocks: int) -> tuple[Column, Column, Column]:
    """(block, word, mask) of a key: six bits of a second hash for each place."""
    block = F.pmod(F.xxhash64(F.col(key)), F.lit(blocks))
    second = F.xxhash64(F.lit("second"), F.col(key))

    def six(k: int) -> Column:
        return F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")

    mask = F.lit(0).cast("long")
    for k in range(HASHED):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), six(k)))
    return block, six(HASHED), mask


def blocks_for(rows: int) -> int:
    return max(1, -(-rows * BITS_PER_KEY // (64 * WORDS)))


def key_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(_block, _words): the filter over the non-null values of ``key``, at most ``blocks`` rows."""
    block, word, mask = _places(key, blocks)
    words = keys.where(F.col(key).isNotNull()).select(block.alias("_block"), word.alias("_word"), mask.alias("_mask"))
    words = words.groupBy("_block", "_word").agg(F.bit_or("_mask").alias("_bits"))
    # At most WORDS entries a block.
    found = words.groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_found"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.col("_found")[w], F.lit(0).cast("long")))
    return found.select("_block", filled.alias("_words"))


def _pays(large: DataFrame, keys: DataFrame) -> bool:
    spark = large.sparkSession
    broadcast = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return stored_bytes(large) >= int(spark.conf.get(MIN_KEY, str(MIN_BYTES))) and planned_bytes(keys) > broadcast


def might_join(large: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``large`` whose ``key`` may be among those of ``keys``: every
    one that is, and under one in fifty of the others.  Null keys join with
    nothing and may go.  Where it pays, ``keys`` is counted once, when this is called."""
    if not _pays(large, keys):
        return large
    blocks = blocks_for(keys.where(F.col(key).isNotNull()).count())
    if blocks * WORDS * 8 > max_broadcast_bytes(large.sparkSession):
        return large
    block, word, mask = _places(key, blocks)
    row = F.struct(*(F.col(c) for c in large.columns)).alias("row")
    placed = large.where(F.col(key).isNotNull()).select(row, block.alias("_at"), word.alias("_word"), mask.alias("_mask"))
    bits = F.get("_words", F.col("_word")).bitwiseAND(F.col("_mask"))
    hit = (F.col("_at") == F.col("_block")) & (bits == F.col("_mask"))
    return placed.join(F.broadcast(key_blocks(keys, key, blocks)), hit, "left_semi").select("row.*")
