"""Exact top-k search by tiled matrix products and a tree merge.

Rows and queries are packed into matrices of bounded size (``tiles``); every
tile, a block of queries and a matrix of rows, is one matrix product, of which
only each query's best leave it (partial selection with exact ties).  A task
merges the lists of the tiles it multiplies; those of different tasks are
merged in a tree of ``FAN_IN`` a step.  Memory does not grow with the input,
and no task ever holds a whole query's candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.llm import tiles
from starlens.llm.common import table
from starlens.llm.tiles import KEY, best, entry, fits, mined, opened, squares, usable  # noqa: F401

FAN_IN = 16
_QUERIES, _CANDIDATES = 256, 8192  # rows multiplied at once within a tile
_EXACT = float(1 << 53)


def product(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products, as 64-bit integers or, where these might not hold them, as Python's."""
    if fits(queries, rows, _EXACT):
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if fits(queries, rows):
        return queries @ rows.T
    return queries.astype(object) @ rows.astype(object).T


def top_k(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 64) -> DataFrame:
    """(query_id, rank, id, score): for each row where ``queries`` holds, the k
    highest integer inner products of floor(scale * x) among all other rows,
    ties to the smaller id.

    Vectors that are null or hold null or non-finite components, and rows with
    a null id, take no part; vectors are compared with those of their own
    length, empty vectors with none.  Rows are ranked, not ids: a row that
    repeats is a candidate as often as it stands, a query that repeats gives
    its list each time, and only a query's own row is left out, once.  Scores
    are ordered exactly; beyond 64 bits they are shown as the largest long of
    their sign.  Fewer than k others give all of them; an empty table gives no
    rows.
    """
    rows = tiles.vectors(vectors, id_col, vector_col, asks=F.coalesce(queries, F.lit(False)))
    shards = tiles.packed(rows, tiles.SHARD_CELLS, scale, "topk-rows")
    blocks = tiles.packed(rows.where("asks"), tiles.BLOCK_CELLS, scale, "topk-queries")

    def multiply(row: dict):
        ids, held = np.frombuffer(row["s_ids"], "<i8"), opened(row["s_matrix"], row["dim"], scale)
        asks = opened(row["q_matrix"], row["dim"], scale)
        for i in range(0, len(asks), _QUERIES):
            for j in range(0, len(held), _CANDIDATES):
                some = ids[j : j + _CANDIDATES]
                for r, scores in enumerate(product(asks[i : i + _QUERIES], held[j : j + _CANDIDATES])):
                    # One more than k, for the query's own row.
                    yield (row["q_part"], row["q_seq"], i + r, 0), [entry(scores[c], some[c]) for c in best(scores, some, k + 1)]

    found = mined(tiles.tiles(blocks, shards), multiply, k + 1, "topk-lists")
    lists = found.select(*KEY, F.spark_partition_id().alias("branch"), "e").groupBy(*KEY, "branch").agg(
        F.slice(F.sort_array(F.collect_list("e")), 1, k + 1).alias("top"))
    width = found.rdd.getNumPartitions()
    while width > 1:
        lists = lists.groupBy(*KEY, F.floor(F.col("branch") / FAN_IN).cast("int").alias("branch")).agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k + 1).alias("top"))
        width = -(-width // FAN_IN)
    return _hits(lists, _own(blocks, scale), k)


def _own(blocks: DataFrame, scale: int) -> DataFrame:
    """(part, seq, at, query_id, own): each query's id and its entry for itself."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                part, seq, dim, ids, matrix = (b.column(c)[i].as_py() for c in range(5))
                ids = np.frombuffer(ids, "<i8")
                own = [dict(zip(("neg", "tail", "id"), entry(s, q))) for s, q in zip(squares(opened(matrix, dim, scale)), ids)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(ids), pa.int32()), pa.array([seq] * len(ids), pa.int32()), pa.array(range(len(ids)), pa.int32()),
                     pa.array(ids, pa.int64()), pa.array(own, tiles.ENTRY_TYPE)], [*KEY, "query_id", "own"])

    return blocks.select("part", "seq", "dim", "ids", "matrix").mapInArrow(
        run, f"part int, seq int, at int, query_id long, own {tiles.ENTRY}")


def _hits(lists: DataFrame, own: DataFrame, k: int) -> DataFrame:
    """The first k of each list without the query's own entry (once)."""
    met = lists.join(own, KEY)
    place = F.array_position("top", F.col("own")).cast("int")  # 0: beyond the list
    others = F.when(place == 0, F.slice("top", 1, k)).otherwise(
        F.concat(F.slice("top", F.lit(1), place - 1), F.slice("top", place + 1, F.lit(k + 1))))
    return met.select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("id"), (-F.col("hit.neg")).alias("score"))


def op10_topk(spark, sf_dir: str) -> DataFrame:
    found = top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


OP10_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20"""
