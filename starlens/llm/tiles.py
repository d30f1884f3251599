"""Packed matrices of integer vectors, tiles of them, and exact scores.

Rows are packed in the order in which a task reads them, one matrix of bounded
size a row of the packed table, so packing moves nothing and no id, vector or
label can make a matrix larger than another.  To multiply a set of queries
with all rows, matrices of rows are dealt over buckets and every block of
queries is sent to every bucket: a tile is one joined row.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import arrow_rows, written

LIMIT = (1 << 63) - 1  # scores beyond it are shown as this
SHARD_CELLS, BLOCK_CELLS = 1 << 20, 1 << 17  # numbers in a matrix of rows, and of queries
SHARDS = 16  # matrices of rows in a bucket, where there are enough of them
TILES = 4  # joined rows handed to Python at once
ENTRY = "struct<neg:bigint,tail:binary,id:bigint>"
ENTRY_TYPE = pa.struct([("neg", pa.int64()), ("tail", pa.binary()), ("id", pa.int64())])


def usable(v: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def vectors(table: DataFrame, id_col: str, vector_col: str, **more: Column) -> DataFrame:
    """(id, x, dim, more...) of the rows that take part: id not null, vector
    usable and not empty.  Floats stay floats until they are packed."""
    x = F.col(vector_col)
    if table.schema[vector_col].dataType.simpleString() != "array<float>":
        x = x.cast("array<double>")
    rows = table.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), x.alias("x"), *(c.alias(n) for n, c in more.items()))
    return rows.where(usable(F.col("x")) & (F.size("x") > 0)).withColumn("dim", F.size("x"))


def _integers(x: np.ndarray, scale: int) -> bytes:
    """floor(scale * x), exactly: two bytes that tell the type, then the
    numbers in the smallest that holds them; beyond 53 bits x itself, times a
    power of two, is what is kept."""
    most = float(np.abs(x).max(initial=0)) * scale
    kind = next((k for k, top in (("i1", 127), ("i2", 32767), ("i4", 2**31 - 1), ("i8", 2.0**53)) if most < top), "f8")
    return kind.encode() + (x if kind == "f8" else np.floor(x * scale)).astype(f"<{kind}").tobytes()


def opened(raw: bytes, dim: int, scale: int) -> np.ndarray:
    """The matrix: 64-bit integers, or Python's where these do not hold them."""
    kind = raw[:2].decode()
    got = np.frombuffer(raw, f"<{kind}", offset=2).reshape(-1, dim)
    if kind != "f8":
        return got.astype(np.int64)
    whole = [[int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale) for v in r] for r in got.tolist()]
    return np.array(whole, object).reshape(-1, dim)


def fits(a: np.ndarray, b: np.ndarray, top: float = 2.0**62) -> bool:
    """Whether every inner product of rows of a and b stays below ``top``."""
    if a.dtype == object or b.dtype == object:
        return False
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1]) < top


def squares(a: np.ndarray) -> np.ndarray:
    """Each row's inner product with itself."""
    if fits(a, a):
        return (a * a).sum(axis=1)
    return np.array([sum(int(v) * int(v) for v in r) for r in a] + [None], object)[:-1]


PACKED = "part int, seq int, dim int, n int, ids binary, labels array<string>, matrix binary"


def packed(rows: DataFrame, cells: int, scale: int, name: str, label: bool = False) -> DataFrame:
    """Matrices of at most ``cells`` numbers (or one row) from rows (id, x, dim
    and label, a string, where ``label``), each in the order of ids; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # by length: ids, labels and vectors of the open matrix
        seq, part, kept = 0, 0, 0

        def flush(dim: int) -> pa.RecordBatch:
            nonlocal seq, kept
            ids, labels, x = (np.concatenate(p) for p in zip(*held.pop(dim)))
            order = np.argsort(ids, kind="stable")
            kept -= x.size
            seq += 1
            values = (part, seq, dim, len(ids), ids[order].astype("<i8").tobytes(), labels[order].tolist() if label else None,
                      _integers(x[order].astype(np.float64), scale))
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.string()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                              ["part", "seq", "dim", "n", "ids", "labels", "matrix"])

        for b in batches:
            if not b.num_rows:
                continue
            part, dims = b.column(0)[0].as_py(), b.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                some = b.filter(pa.array(dims == dim))
                x = some.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                ids = some.column(1).to_numpy()
                labels = some.column(4).to_numpy(zero_copy_only=False) if label else np.zeros(len(ids), np.int8)
                at, per = 0, max(1, cells // dim)
                while at < len(ids):
                    room = per - sum(len(p[0]) for p in held.get(dim, ()))
                    held.setdefault(dim, []).append((ids[at : at + room], labels[at : at + room], x[at : at + room]))
                    kept += x[at : at + room].size
                    at += room
                    if sum(len(p[0]) for p in held[dim]) >= per:
                        yield flush(dim)
                while kept > 4 * cells:  # vectors of many lengths
                    yield flush(max(held, key=lambda d: sum(p[2].size for p in held[d])))
        for dim in [*held]:
            yield flush(dim)

    columns = [F.spark_partition_id().alias("part"), "id", "dim", "x", *(["label"] if label else [])]
    with arrow_rows(rows.sparkSession, 4096):
        return written(rows.select(*columns).mapInArrow(run, PACKED), name)


def tiles(blocks: DataFrame, shards: DataFrame, extra: str | None = None) -> DataFrame:
    """(dim, q_*, s_*): a row for every matrix of queries and matrix of rows
    of equal width.  ``extra`` names a further column of the blocks."""
    n = shards.count()  # of matrices
    buckets = max(-(-n // SHARDS), min(n, shards.sparkSession.sparkContext.defaultParallelism), 1)
    body = ["part", "seq", "ids", "labels", "matrix"]
    q = blocks.select("dim", *(F.col(c).alias(f"q_{c}") for c in body), *([extra] if extra else []))
    q = q.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    s = shards.select("dim", *(F.col(c).alias(f"s_{c}") for c in body))
    s = s.withColumn("bucket", F.pmod(F.xxhash64("s_part", "s_seq"), F.lit(buckets)).cast("int"))
    return q.join(s, ["dim", "bucket"]).drop("bucket")


def mapped(joined: DataFrame, run, schema: str, name: str) -> DataFrame:
    """``run`` over the joined rows, few at a time, written."""
    with arrow_rows(joined.sparkSession, TILES):
        return written(joined.mapInArrow(run, schema), name)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids; ids ascend."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:k], np.int64)
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)  # more than k where the last place is tied
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")][:k]


def entry(score: int, id_: int) -> tuple[int, bytes | None, int]:
    """A list's entry; entries in ascending order are scores in descending
    order, ties by id.  Scores beyond 64 bits are ordered by their tail."""
    score = int(score)
    if -LIMIT < score < LIMIT:
        return -score, None, int(id_)
    size = (abs(score).bit_length() + 7) // 8
    body = abs(score).to_bytes(size, "big")
    tail = (0x8000 + size).to_bytes(2, "big") + body if score < 0 else (0x8000 - size).to_bytes(2, "big") + bytes(255 - x for x in body)
    return (-LIMIT if score > 0 else LIMIT), tail, int(id_)


def exact(neg: int, tail: bytes | None) -> int:
    """The score of an entry."""
    if tail is None:
        return -neg
    if tail[0] & 0x80:
        return -int.from_bytes(tail[2:], "big")
    return int.from_bytes(bytes(255 - x for x in tail[2:]), "big")




KEY = ["part", "seq", "at"]  # of a query: its matrix, and its place there
HELD = 8192  # heaps that a task merges before it hands them on


def merged(one: list, other: list, k: int) -> list:
    """The k smallest entries of two ascending lists."""
    return [*islice(heapq.merge(one, other, key=lambda e: (e[0], e[1] or b"", e[2])), k)]


def _emit(heaps: dict[tuple, list]) -> pa.RecordBatch:
    keys = [k for k, v in heaps.items() for _ in v]
    flat = [dict(zip(("neg", "tail", "id"), e)) for v in heaps.values() for e in v]
    cols = [pa.array([k[i] for k in keys], pa.int32()) for i in range(4)]
    return pa.RecordBatch.from_arrays([*cols, pa.array(flat, ENTRY_TYPE)], [*KEY, "pos", "e"])


def mined(joined: DataFrame, pick: Callable[[dict], Iterator[tuple[tuple, list]]], k: int, name: str) -> DataFrame:
    """(part, seq, at, pos, e), written: the lists of at most k entries that
    ``pick`` gives for a tile under (part, seq, at, pos), merged within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple, list] = {}
        for b in batches:
            for i in range(b.num_rows):
                for key, found in pick({n: b.column(c)[i].as_py() for c, n in enumerate(b.schema.names)}):
                    heaps[key] = merged(heaps[key], found, k) if key in heaps else found
                if len(heaps) > HELD:
                    yield _emit(heaps)
                    heaps = {}
        yield _emit(heaps)

    return mapped(joined, run, f"part int, seq int, at int, pos int, e {ENTRY}", name)
