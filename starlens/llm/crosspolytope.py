"""Near-duplicate embeddings: cross-polytope hashing after fast Hadamard rotations.

A vector is rotated pseudo-randomly (random signs and a fast Hadamard
transform, three times); its hash is the signed axis nearest to it.  A table
combines ``hashes`` such values (one by default, in every dimension and at
every size), and multiprobe enters a vector under its two nearest axes of each,
so that in 64 dimensions a pair of cosine 0.93 meets in one table with
probability 0.88, and in at least one of the four with 0.9998.  Members of a
bucket are compared exactly, in double precision.

Copies of a vector under one label are one class before anything is hashed; a
class has a number of its own, so an id that stands under two labels is two
vectors.  An entry of a bucket carries no vector but a sketch, ``BITS`` bits a
component with the length of what rounding took away.  By the triangle
inequality two sketches bound the cosine from both sides: most pairs are linked
or not by the bounds alone.  Members that have a pair between the bounds meet
once more in that bucket, with their vectors, and those pairs are compared
exactly, in double precision.

Links are counted inside the buckets, never emitted as pairs: a pair counts
only in the first bucket that its two hash lists share, and a bucket's
connections leave it as a star.  A bucket of more than ``BLOCK`` members is cut
into blocks and compared block by block, each tile a task's row, so a hot label
or a large group of near copies is spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import arrow_rows, components, table, written
from starlens.llm.tiles import usable

THRESHOLD = 0.93
BLOCK = 2048
PROBES = 2  # nearest axes of each hash under which a vector is entered
HASHES = 1  # in a table
TABLES = {1: 4, 2: 6}  # by the number of hashes in a table
SEED = 7
BITS = 5  # of a component in a sketch
SLACK = 1e-9  # of the bounds, far above the rounding of doubles
_PAIRS = 1 << 18  # pairs whose hash lists are compared at once


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def _width(dim: int) -> int:
    return 1 << max(0, (dim - 1).bit_length())


def axes(x: np.ndarray, tables: int, hashes: int) -> np.ndarray:
    """(row, table, hash, probe): the nearest signed axes, nearest first."""
    width = _width(x.shape[1])
    padded = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    probes = min(PROBES, width)
    out = np.empty((len(x), tables, hashes, probes), np.int32)
    for t, k in product(range(tables), range(hashes)):
        signs = np.random.default_rng([SEED, t, k]).choice([-1.0, 1.0], size=(3, width))
        turned = padded
        for s in signs:
            turned = hadamard(turned * s)
        near = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, :probes]
        out[:, t, k] = 2 * near + (np.take_along_axis(turned, near, 1) < 0)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def sketch(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers, step, error) of unit rows: numbers of ``BITS`` bits, and the
    length of what a row differs from its numbers times its step."""
    step = (np.abs(x).max(axis=1) / ((1 << BITS - 1) - 1)).astype(np.float32)
    numbers = np.rint(x / step[:, None].astype(np.float64))
    error = np.linalg.norm(x - numbers * step[:, None].astype(np.float64), axis=1)
    return numbers, step, np.nextafter(error.astype(np.float32), np.float32(np.inf))


def _code_type(dim: int) -> np.dtype:
    return np.min_scalar_type(2 * _width(dim) - 1)


def bodies(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A row of bytes for each vector: its sketch and its hash list."""
    numbers, step, error = sketch(x)
    shifted = (numbers + (1 << BITS - 1)).astype(np.uint8)
    packed = np.packbits(np.unpackbits(shifted[:, :, None], axis=2)[:, :, 8 - BITS :].reshape(len(x), -1), axis=1)
    small = codes.reshape(len(x), -1).astype(_code_type(x.shape[1]))
    return np.concatenate([packed, np.stack([step, error], 1).view(np.uint8), small.view(np.uint8)], axis=1)


def opened(ids: np.ndarray, copies: np.ndarray, body: bytes, dim: int, hashes: int, tables: int) -> dict:
    rows = np.frombuffer(body, np.uint8).reshape(len(ids), -1)
    end = -(-dim * BITS // 8)
    bits = np.unpackbits(rows[:, :end], axis=1)[:, : dim * BITS].reshape(len(ids), dim, BITS)
    numbers = bits @ (1 << np.arange(BITS)[::-1]).astype(np.float64) - (1 << BITS - 1)
    step, error = np.ascontiguousarray(rows[:, end : end + 8]).view(np.float32).T
    codes = np.ascontiguousarray(rows[:, end + 8 :]).view(_code_type(dim)).astype(np.int32)
    return {"ids": ids, "copies": copies, "numbers": numbers, "step": step, "error": error, "codes": codes.reshape(len(ids), tables, hashes, -1)}


def bounds(a: dict, b: dict) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, margin) of the cosines of two tiles' members.  Every step is
    exact or symmetric, so a pair has the same bounds wherever it is compared."""
    step = a["step"].astype(np.float64)[:, None] * b["step"].astype(np.float64)
    left, right = a["error"].astype(np.float64)[:, None], b["error"].astype(np.float64)
    return (a["numbers"] @ b["numbers"].T) * step, (left + right) + left * right + SLACK


def bucket_keys(table_no: int, codes: np.ndarray, dim: int) -> np.ndarray:
    """The table's number and the axes as digits of one integer."""
    keys = np.full(len(codes), table_no, np.int64)
    for k in range(codes.shape[1]):
        keys = keys * (2 * _width(dim)) + codes[:, k]
    return keys


def _digits(key: int, dim: int, hashes: int) -> tuple[int, np.ndarray]:
    out = []
    for _ in range(hashes):
        key, digit = divmod(key, 2 * _width(dim))
        out.append(digit)
    return key, np.array(out[::-1])


def _first_here(a: np.ndarray, b: np.ndarray, table_no: int, bucket: np.ndarray) -> np.ndarray:
    """Of pairs of hash lists that share ``bucket`` in table ``table_no``:
    whether this is the first bucket they share."""
    same = a[:, :, :, :, None] == b[:, :, :, None, :]  # pair, table, hash, probe, probe
    before = same[:, :table_no].any((3, 4)).all(2).any(1)
    here = a[:, table_no]
    shared = np.where(same[:, table_no].any(3), here, np.iinfo(np.int32).max).min(2)
    return ~before & (shared == bucket).all(1)


def _here(mask: np.ndarray, a: dict, b: dict, table_no: int, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of ``mask`` whose first shared bucket is this one."""
    left, right = np.nonzero(mask)
    kept = [np.zeros(0, bool)]
    for at in range(0, len(left), _PAIRS):
        i, j = left[at : at + _PAIRS], right[at : at + _PAIRS]
        kept.append(_first_here(a["codes"][i], b["codes"][j], table_no, bucket))
    kept = np.concatenate(kept)
    return left[kept], right[kept]


def counted(ids: np.ndarray, copies: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(links, roots) by linked pairs: links count copies, a root is the
    smallest id that a member is connected with."""
    links, root = np.zeros(len(ids), np.int64), ids.copy()
    np.add.at(links, left, copies[right])
    np.add.at(links, right, copies[left])
    while len(left):
        low = np.minimum(root[left], root[right])
        was = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        if (root == was).all():
            break
    return links, root


def compare(a: dict, other: dict | None, key: int, dim: int, hashes: int, threshold: float) -> tuple[np.ndarray, ...]:
    """(id, links, root, open, second) of the members of a block compared with each
    other, or of two blocks: linked by their sketches, or open because a
    pair's bounds lie on both sides of the threshold."""
    b = other or a
    estimate, margin = bounds(a, b)
    sure = estimate - margin >= threshold
    between = ~sure & (estimate + margin >= threshold)
    if not other:
        sure, between = np.triu(sure, 1), np.triu(between, 1)
    at = _digits(key, dim, hashes)
    left, right = _here(sure, a, b, *at)
    open_left, open_right = _here(between, a, b, *at)
    ids, copies, shift = a["ids"], a["copies"], 0
    if other:
        ids, copies, shift = np.concatenate([ids, b["ids"]]), np.concatenate([copies, b["copies"]]), len(ids)
    links, root = counted(ids, copies, left, right + shift)
    is_open = np.zeros(len(ids), bool)
    is_open[open_left] = is_open[open_right + shift] = True
    told = is_open | (links > 0)
    return ids[told], links[told], root[told], is_open[told], (np.arange(len(ids)) >= len(a["ids"]))[told]


def settle(ids: np.ndarray, copies: np.ndarray, x: np.ndarray, second: np.ndarray, crossed: bool, key: int,
           tables: int, hashes: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, links, root) of open members: their pairs between the bounds, by
    exact cosines.  ``crossed``: only pairs of the first with the second block."""
    numbers, step, error = sketch(x)
    all_of = {"numbers": numbers, "step": step, "error": error, "codes": axes(x, tables, hashes)}
    a, b = np.nonzero(~second)[0], np.nonzero(second)[0] if crossed else np.arange(len(ids))
    one, two = ({k: v[rows] for k, v in all_of.items()} for rows in (a, b))
    estimate, margin = bounds(one, two)
    between = (estimate - margin < threshold) & (estimate + margin >= threshold) & (x[a] @ x[b].T >= threshold)
    left, right = _here(between if crossed else np.triu(between, 1), one, two, *_digits(key, x.shape[1], hashes))
    links, root = counted(ids, copies, a[left], b[right])
    told = links > 0
    return ids[told], links[told], root[told]


KEY = ["label", "dim", "bucket"]
TILE = [*KEY, "block", "other"]
KEYS = "label string, dim int, bucket long"
OUT = "id long, links long, root long"
FOUND = f"{OUT}, open boolean, second boolean, {KEYS}, block int, other int"
NAMES = [c.split()[0] for c in FOUND.split(", ")]


def _matrix(x: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    return unit(x.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64))


def _told(parts: tuple[np.ndarray, ...], at: list) -> pa.RecordBatch:
    """Rows of ``FOUND`` for one tile."""
    kinds = [pa.int64()] * 3 + [pa.bool_()] * 2
    cols = [pa.array(c, k) for c, k in zip(parts, kinds)]
    fixed = [pa.array([v] * len(parts[0]), k) for v, k in zip(at, (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32()))]
    return pa.RecordBatch.from_arrays([*cols, *fixed], NAMES)


def _members(t: pa.Table) -> tuple[np.ndarray, np.ndarray, bytes]:
    return t["id"].to_numpy().astype("<i8"), t["copies"].to_numpy().astype("<i8"), b"".join(t["body"].to_pylist())


def link_counts(classes: DataFrame, threshold: float, hashes: int, tables: int, block: int = BLOCK) -> DataFrame:
    """(id, links, root) from classes (id, label, dim, x, copies), written:
    partial counts and star edges, a row for each bucket in which a class is linked."""

    def entered(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch.column(2).to_numpy()
                for dim in np.unique(dims).tolist():
                    rows = batch.filter(pa.array(dims == dim))
                    x = _matrix(rows.column(3), dim)
                    codes = axes(x, tables, hashes)
                    more = []
                    if whole:
                        body = bodies(x, codes)
                        ends = pa.py_buffer((np.arange(len(x) + 1) * body.shape[1]).astype(np.int32))
                        more = [rows.column(0), rows.column(4), pa.Array.from_buffers(pa.binary(), len(x), [None, ends, pa.py_buffer(body.tobytes())])]
                    for t, probe in product(range(tables), product(range(codes.shape[3]), repeat=hashes)):
                        keys = pa.array(bucket_keys(t, codes[:, t, range(hashes), probe], dim))
                        yield pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), keys, *more], [*KEY, *(["id", "copies", "body"] if whole else [])])

        return classes.select("id", "label", "dim", "x", "copies").mapInArrow(run, KEYS + (", id long, copies long, body binary" if whole else ""))

    # Only large buckets need blocks; they are counted without their sketches.
    large = entered(False).groupBy(KEY).agg(F.count("*").alias("n")).where(F.col("n") > block)
    large = written(large.select(*KEY, F.ceil(F.col("n") / block).cast("int").alias("blocks")), "vector-large")
    entries = entered(True).join(large, KEY, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    entries = entries.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def within(t: pa.Table) -> pa.Table:
        label, dim, key, at = (t[c][0].as_py() for c in (*KEY, "block"))
        one = opened(*_members(t), dim, hashes, tables)
        return pa.Table.from_batches([_told(compare(one, None, key, dim, hashes, threshold), [label, dim, key, at, at])])

    found = written(entries.groupBy(*KEY, "block").applyInArrow(within, FOUND), "vector-links")
    if not large.isEmpty():
        found = found.unionByName(_between_blocks(entries.where("blocks > 1"), threshold, hashes, tables))

    def exactly(t: pa.Table) -> pa.Table:
        key, dim, crossed = t["bucket"][0].as_py(), t["dim"][0].as_py(), t["block"][0].as_py() != t["other"][0].as_py()
        ids, copies = (t[c].to_numpy().astype("<i8") for c in ("id", "copies"))
        parts = settle(ids, copies, _matrix(t["x"], dim), t["second"].to_numpy().astype(bool), crossed, key, tables, hashes, threshold)
        return pa.table([pa.array(c, pa.int64()) for c in parts], ["id", "links", "root"])

    again = found.where("open").select("id", "second", *TILE).join(classes.select("id", "copies", "x"), "id")
    settled = written(again.groupBy(*TILE).applyInArrow(exactly, OUT), "vector-settled")
    return found.where("links > 0").select("id", "links", "root").unionByName(settled)


def _between_blocks(entries: DataFrame, threshold: float, hashes: int, tables: int) -> DataFrame:
    """``FOUND`` rows of each pair of blocks of a bucket, written; a block is one row of bytes."""
    body = ["ids", "copies", "body"]

    def pack(t: pa.Table) -> pa.Table:
        ids, copies, rest = _members(t)
        one = {c: [t[c][0].as_py()] for c in (*KEY, "block", "blocks")}
        kinds = {"dim": pa.int32(), "block": pa.int32(), "blocks": pa.int32()}
        return pa.table({c: pa.array(v, kinds.get(c)) for c, v in one.items()}
                        | {c: pa.array([v], pa.binary()) for c, v in zip(body, (ids.tobytes(), copies.tobytes(), rest))})

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tile, other = (opened(np.frombuffer(row["ids" + end], "<i8"), np.frombuffer(row["copies" + end], "<i8"), row["body" + end],
                                      row["dim"], hashes, tables) for end in ("", "_b"))
                yield _told(compare(tile, other, row["bucket"], row["dim"], hashes, threshold), [row[c] for c in TILE])

    packed = written(entries.groupBy(*KEY, "block").applyInArrow(
        pack, f"{KEYS}, block int, blocks int, ids binary, copies binary, body binary"), "vector-blocks")
    a = packed.withColumn("other", F.explode(F.expr("filter(sequence(block, blocks), j -> j > block AND j < blocks)")))
    b = packed.withColumn("other", F.col("block")).withColumn("block", F.explode(F.expr("filter(sequence(0, other), i -> i < other)")))
    pairs = a.join(b.select(*TILE, *(F.col(c).alias(f"{c}_b") for c in body)), TILE)
    with arrow_rows(entries.sparkSession, 4):
        return written(pairs.select(*TILE, *body, *(f"{c}_b" for c in body)).mapInArrow(between, FOUND), "vector-links-between")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD, hashes: int = HASHES) -> DataFrame:
    """(id, n_links, component_id, kept): one row per input row.

    Vectors of equal, non-null label and equal length link at a cosine of at
    least ``threshold``; n_links counts the other vectors linked directly.  Rows
    whose id or label is null, or whose vector is null, empty, zero or holds a
    null or non-finite component, link with nothing and are their own
    component.  Rows equal in id, label and vector are one vector; rows that
    share an id only are vectors of their own, so an id under two labels is
    linked under each by itself.  An empty table gives no rows.
    """
    x = F.col(vector_col)  # floats stay floats until they are compared: half the bytes to move
    if vectors.schema[vector_col].dataType.simpleString() != "array<float>":
        x = x.cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), x.alias("x"))
    links = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("x")) & F.exists("x", lambda c: c != 0)
    rows = rows.withColumn("x", F.when(F.coalesce(links, F.lit(False)), F.col("x")))
    # Rows find their class by two hashes of label and vector, by these themselves should two classes share both.
    key, rows = ["h1", "h2"], rows.withColumns({
        "h1": F.when(F.col("x").isNotNull(), F.xxhash64("label", "x")), "h2": F.when(F.col("x").isNotNull(), F.xxhash64(F.lit(1), "x", "label"))})
    used = rows.where("x IS NOT NULL")
    classes = written(
        used.groupBy("label", "x").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), *(F.min(c).alias(c) for c in key))
        .withColumns({"dim": F.size("x"), "id": F.monotonically_increasing_id()}), "vector-classes")  # the class's number
    if not classes.groupBy(*key).count().where("count > 1").isEmpty():
        key = ["label", "x"]
    repeats = used.groupBy(*key, "id").count().where("count > 1")
    repeats = written(repeats.groupBy(*key).agg((F.sum("count") - F.count("*")).alias("repeats")), "vector-repeats")
    if not repeats.isEmpty():  # rows equal in id, label and vector count once
        fewer = F.col("copies") - F.coalesce("repeats", F.lit(0))
        classes = written(classes.join(repeats, key, "left").withColumn("copies", fewer).drop("repeats"), "vector-classes-once")
    found = link_counts(classes, threshold, hashes, TABLES[hashes])
    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "id")
    classes = classes.select("id", "rep", "copies", *key).join(linked, "id", "left").join(comp, "id", "left").select(
        *key, "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component"))
    classes = written(classes, "vector-numbered")
    named = written(classes.groupBy("component").agg(F.min("rep").alias("component_id")), "vector-components")
    classes = written(classes.join(named, "component").select(*key, "n_links", "component_id"), "vector-named")
    out = rows.select("id", *key).join(classes, key, "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def op6_near_vectors(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


OP6_SQL = f"""
WITH RECURSIVE given AS (
  SELECT DISTINCT vec_id, label, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), v AS (
  SELECT row_number() OVER (ORDER BY vec_id, label, embedding) AS r, vec_id, label, embedding, embedding::DOUBLE[] AS e FROM given
), links AS (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}
), reach AS (
  SELECT r AS node, r AS root FROM v
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node
), comp AS (
  SELECT node, min(vec_id) AS component_id FROM reach JOIN v ON root = r GROUP BY node
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
), named AS (
  SELECT v.vec_id, v.label, v.embedding, coalesce(n, 0) AS n_links, component_id FROM v JOIN comp ON node = r LEFT JOIN counted ON a = r
)
SELECT g.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, g.vec_id) AS component_id,
  g.vec_id IS NOT DISTINCT FROM coalesce(component_id, g.vec_id) AS kept
FROM embeddings g LEFT JOIN named n ON g.vec_id = n.vec_id AND g.label = n.label AND g.embedding = n.embedding"""
