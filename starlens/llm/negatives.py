"""Hard-negative mining by Strassen products of integer tiles.

Anchors and candidates are packed into matrices of integers (``tiles``); a
tile multiplies a block of anchors with a matrix of candidates by Strassen's
recursion: each side is split into quarters, padded with zeros to even sides,
and seven products of sums and differences take the place of eight.  All of it
is integer addition and multiplication modulo 2^64, so a result that fits in
64 bits is exact whatever the intermediate sums do; where one might not fit,
the same recursion runs on Python's integers.

The first pass keeps each anchor's best candidates of its own label, a heap a
tile; heaps are merged within a task and then across tasks by a ranked window,
which Spark limits map-side.  The second pass keeps, for each anchor and each
of its positives, the best candidates of other labels whose score lies in the
window that the positive's score sets, merged in the same way.  Candidates are
read in the order of labels, so the first pass multiplies only tiles in which
a label meets itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.llm import tiles
from starlens.llm.common import table, written
from starlens.llm.tiles import KEY, best, entry, exact, fits, mined, opened, squares

LEAF = 32  # a side up to which a product is not split further
ANCHORS, CANDIDATES = 256, 4096  # rows multiplied at once within a tile


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The matrix product of a (m, k) and b (k, n), exact in their ring."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    m2, k2, n2 = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    a11, a12, a21, a22 = a[:m2, :k2], a[:m2, k2:], a[m2:, :k2], a[m2:, k2:]
    b11, b12, b21, b22 = b[:k2, :n2], b[:k2, n2:], b[k2:, :n2], b[k2:, n2:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m2, 2 * n2), np.result_type(a, b))
    out[:m2, :n2] = p1 + p4 - p5 + p7
    out[:m2, n2:] = p3 + p5
    out[m2:, :n2] = p2 + p4
    out[m2:, n2:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of all anchors with all candidates."""
    if not fits(anchors, candidates):
        anchors, candidates = anchors.astype(object), candidates.astype(object)
    return strassen(anchors, candidates.T)


class _Tile:
    """One joined row: its anchors, candidates, and their labels as numbers."""

    def __init__(self, row: dict, scale: int) -> None:
        self.key = (row["q_part"], row["q_seq"])
        self.own, self.ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["s_ids"], "<i8")
        names = {x: i for i, x in enumerate(dict.fromkeys([*row["q_labels"], *row["s_labels"]]))}
        self.own_label, self.label = (np.array([names[x] for x in row[c]], np.int64) for c in ("q_labels", "s_labels"))
        self.raw, self.scale, self.dim = (row["q_matrix"], row["s_matrix"]), scale, row["dim"]

    def __iter__(self) -> Iterator[tuple[int, slice, np.ndarray]]:
        """(anchor's place, candidates, its scores with them)."""
        a, b = (opened(raw, self.dim, self.scale) for raw in self.raw)
        for i in range(0, len(a), ANCHORS):
            for j in range(0, len(b), CANDIDATES):
                scores = products(a[i : i + ANCHORS], b[j : j + CANDIDATES])
                for r in range(len(scores)):
                    yield i + r, slice(j, j + CANDIDATES), scores[r]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k first entries of each anchor and positive, with their place."""
    order = Window.partitionBy(*KEY, "pos").orderBy("e")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A row's score is the inner product of floor(scale * x) with its anchor's;
    higher scores come first, ties by smaller id.  For each row where
    ``anchors`` holds, and each of its first ``n_positives`` other rows of
    equal label, the first ``n_negatives`` rows of another label with
    low * positive <= 100 * negative <= high * positive, ranked from 1; fewer
    where there are fewer, none for a positive below zero.

    Rows with a null id or label, or with a null or empty vector or one that
    holds a null or non-finite component, take no part; vectors are compared
    with those of their own length.  Rows are ranked, not ids: a row that
    repeats is a candidate as often as it stands, an anchor that repeats gives
    its rows each time, and "other rows" excludes the anchor's own row once.
    Scores are ordered and compared exactly; beyond 64 bits they are shown as
    the largest long of their sign.  An empty table gives no rows.
    """
    rows = tiles.vectors(vectors.where(F.col(label_col).isNotNull()), id_col, vector_col,
                         label=F.col(label_col).cast("string"), asks=F.coalesce(anchors, F.lit(False)))
    # Rows of equal label lie together; the number splits a label that holds many, and rows that are all alike.
    dealt = rows.withColumn("n", F.monotonically_increasing_id()).repartitionByRange("label", "n").sortWithinPartitions("label", "n")
    shards = tiles.packed(dealt, tiles.SHARD_CELLS, scale, "negatives-rows", label=True)
    blocks = tiles.packed(rows.where("asks"), tiles.BLOCK_CELLS, scale, "negatives-anchors", label=True)

    def positives(row: dict):
        tile = _Tile(row, scale)
        if not np.isin(tile.label, tile.own_label).any():
            return
        of = {c: np.flatnonzero(tile.label == c) for c in np.unique(tile.own_label)}
        for at, some, scores in tile:
            mine = of[tile.own_label[at]]
            mine = mine[(mine >= some.start) & (mine < some.stop)]
            if len(mine):
                s = scores[mine - some.start]
                yield (*tile.key, at, 0), [entry(s[i], tile.ids[mine[i]]) for i in best(s, tile.ids[mine], n_positives + 1)]

    first = _ranked(mined(tiles.tiles(blocks, shards), positives, n_positives + 1, "negatives-positives"), n_positives + 1)
    lists = first.groupBy("part", "seq", "at").agg(F.sort_array(F.collect_list("e")).alias("es"))  # at most n_positives + 1
    lists = lists.groupBy("part", "seq").agg(F.collect_list(F.struct("at", "es")).alias("found"))  # a block's anchors
    asking = written(blocks.join(lists, ["part", "seq"]).withColumn("found", F.sort_array("found")), "negatives-asking")

    def in_window(row: dict):
        tile = _Tile(row, scale)
        own = squares(opened(row["q_matrix"], row["dim"], scale))
        scores_of = {}
        for x in row["found"]:
            es = [(e["neg"], e["tail"], e["id"]) for e in x["es"]]
            me = entry(own[x["at"]], tile.own[x["at"]])
            es = [e for i, e in enumerate(es) if i != (es.index(me) if me in es else n_positives)]  # without its own row
            scores_of[x["at"]] = [exact(*e[:2]) for e in es]
        other = {c: np.flatnonzero(tile.label != c) for c in np.unique(tile.own_label)}
        for at, some, scores in tile:
            rest = other[tile.own_label[at]]
            rest = rest[(rest >= some.start) & (rest < some.stop)]
            s = scores[rest - some.start]
            for pos, p in enumerate(scores_of.get(at, ())):
                if p < 0:
                    continue
                inside = np.flatnonzero((s >= -(-low * p // 100)) & (s <= high * p // 100))
                if len(inside):
                    ids = tile.ids[rest[inside]]
                    yield (*tile.key, at, pos), [entry(s[inside[i]], ids[i]) for i in best(s[inside], ids, n_negatives)]

    asked = tiles.tiles(asking, shards, "found")
    last = _ranked(mined(asked, in_window, n_negatives, "negatives-windows"), n_negatives)

    def opened_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchors and their positives, one row each, in the order of scores."""
        for b in batches:
            for i in range(b.num_rows):
                part, seq, dim, ids, matrix, found = (b.column(c)[i].as_py() for c in range(6))
                own, ids, out = squares(opened(matrix, dim, scale)), np.frombuffer(ids, "<i8"), []
                for x in found:
                    es = [(e["neg"], e["tail"], e["id"]) for e in x["es"]]
                    me = entry(own[x["at"]], ids[x["at"]])
                    es = [e for j, e in enumerate(es) if j != (es.index(me) if me in es else n_positives)]
                    out += [(part, seq, x["at"], pos, int(ids[x["at"]]), e[2], -e[0]) for pos, e in enumerate(es)]
                kinds = [pa.int32()] * 4 + [pa.int64()] * 3
                names = [*KEY, "pos", "anchor_id", "positive_id", "positive_score"]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], names)

    pairs = asking.select("part", "seq", "dim", "ids", "matrix", "found").mapInArrow(
        opened_lists, "part int, seq int, at int, pos int, anchor_id long, positive_id long, positive_score long")
    return last.join(pairs, [*KEY, "pos"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("e.id").alias("negative_id"),
        "positive_score", (-F.col("e.neg")).alias("negative_score"))


def op12_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, c.r AS cr, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.r <> c.r WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) AS place FROM scored WHERE same
), hard AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.cr ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON n.ar = p.ar AND NOT n.same
  WHERE p.place <= 5 AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 10"""
