"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints differ in at most ``max_bits`` (even) bits exactly
when some value lies within ``max_bits / 2`` bits of both.  So every distinct
fingerprint emits all values of that ball, the values are shuffled, and
fingerprints that meet on one are linked.  A value is shared by at most as
many distinct fingerprints as the ball has members (65 for ``max_bits = 2``),
whatever the number of documents, and linking each to the smallest of its
value loses no connection.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlens.llm.common import checkpointed, components, written

SEED = 42
_BLOCK = 1 << 16  # shingles whose bits are unpacked at once


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of the word shingles of a text as a signed 64-bit integer."""
    w = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        grams = zip(*(w[at + k : at + min(_BLOCK, n - at) + k] for k in range(min(words, len(w)))))
        h = np.array([xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, h, fp): one row per input row, h being the text's xxhash64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array((fingerprint(t.as_py(), words) for t in b.column(2)), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fps], ["id", "h", "fp"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("t"))
    return rows.mapInArrow(run, "id long, h long, fp long")


def ball(radius: int) -> list[int]:
    """XOR masks (signed) of all values within ``radius`` bits."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(64), r)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): verified links between distinct fingerprints whose transitive
    closure joins all fingerprints within ``max_bits`` of each other."""
    if max_bits % 2 or not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0, 2 or 4")
    masks = F.array(*[F.lit(m) for m in ball(max_bits // 2)])
    near = fps.repartition("fp").select("fp", F.explode(masks).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("value"))
    first = F.min("fp").over(Window.partitionBy("value"))
    met = near.select("fp", first.alias("first")).where("fp != first").distinct()
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("first"))) <= max_bits).select(
        F.col("first").alias("a"), F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 3, max_bits: int = 2) -> DataFrame:
    """(id, h, fp, root, component_id): every input row with the hash of its
    text, its fingerprint, its component's smallest fingerprint, and the
    smallest id reachable over links of at most ``max_bits`` differing bits.

    Null and blank texts have fingerprint zero and are linked like any other.
    Rows that repeat (or share an id) each give a row.  A row with a null id
    keeps its fingerprint and component, but names none: a component of null
    ids alone has a null component_id.  An empty table gives no rows; a very
    long text is hashed whole, in blocks of shingles; other columns of ``docs``
    are not read.  Equal fingerprints are collapsed before
    anything is paired, so groups of copies cost one row.
    """
    fps = written(fingerprints(docs, id_col, text_col, words), "simhash")
    classes = checkpointed(fps.groupBy("fp").agg(F.min("id").alias("least_id")))
    comp = components(links(classes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    named = classes.join(comp, "fp", "left").select("fp", "least_id", F.coalesce("component", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(smallest, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select("id", "h", "fp", "root", "component_id")


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    from starlens.llm.common import table

    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
