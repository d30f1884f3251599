"""Line deduplication over content-defined chunks of lines.

A text is split into lines, and a chunk ends at every local minimum of a
rolling hash over the values of the last ``WINDOW`` lines: where it is below
that of the line before and not above that of the line after.  A boundary thus
depends on the lines next to it only, and survives lines inserted elsewhere.
Two minima are never next to each other and a last single line belongs to the
chunk before it, so every chunk has two lines or more, but for a text of one
line.  A chunk of several lines that occurs again anywhere in the corpus is
removed everywhere but at its first occurrence, after its bytes have been
compared.  Of a passage that repeats in other surroundings all goes between
its first and last inner boundary, which lie some three lines from its ends.

DataFrame functions only.  Chunk hashes are counted first (a few bytes a
chunk, pre-aggregated, so a chunk shared by a third of all documents is one
row a task); texts move only by document.  Bytes are compared by grouping the
candidate chunks by hash and text; a hash that stands for different texts is
decided by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import table, written

WINDOW = 2
BASE = 31


def line_value(line: Column) -> Column:
    """A number below 2^32 from the line's bytes."""
    return F.conv(F.left(F.md5(line.cast("binary")), F.lit(8)), 16, 10).cast("long")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, t, h): the input row whole, its id, its text and the text's hash."""
    d = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return d.withColumn("h", F.xxhash64("t"))


def chunked(d: DataFrame) -> DataFrame:
    """Replace t by lines and chunks, the chunks in order as structs (n, text)."""
    d = d.withColumn("lines", F.split("t", "\n", -1)).drop("t").withColumn("v", F.transform("lines", line_value))
    rolling = " + ".join(f"{BASE ** k}L * (CASE WHEN i >= {k} THEN v[i - {k}] ELSE 0L END)" for k in range(WINDOW))
    d = d.withColumn("r", F.expr(f"transform(v, (x, i) -> {rolling})")).drop("v")
    d = d.withColumn("ends", F.expr(
        "filter(sequence(1, size(lines)), i -> i = size(lines) OR (i > 1 AND i < size(lines) - 1 "
        "AND element_at(r, i) < element_at(r, i - 1) AND element_at(r, i) <= element_at(r, i + 1)))")).drop("r")
    before = "(CASE WHEN k = 0 THEN 0 ELSE ends[k - 1] END)"
    return d.withColumn("chunks", F.expr(
        f"transform(ends, (e, k) -> named_struct('n', e - {before}, "
        f"'text', array_join(slice(lines, {before} + 1, e - {before}), '\\n')))")).drop("ends")


def dedup_line_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, text, n_lines, n_removed): one row per input row, ``row`` being
    the input row as a struct (so no column name can clash), ``text`` its
    remaining lines.

    The first occurrence of a chunk, in the order of id (nulls first), text
    hash and place, stays.  Rows equal in id and text are one document: they
    do not count as repeats of each other and are treated alike.  A null text
    stays null with 0 lines; an empty text is one empty line; a text of one
    line stays as it is; a text whose chunks all go becomes empty.  A very
    long text is one row with all its lines, and is cut like any other.  An
    empty table gives no rows.
    """
    rows = _rows(docs, id_col, text_col)
    here = F.struct("id", "h", "idx")
    hashed = F.transform("chunks", lambda c: F.struct(c["n"].alias("n"), F.xxhash64(c["text"]).alias("ch")))
    occurrences = (
        chunked(rows.select("id", "h", "t")).select("id", "h", F.posexplode(hashed).alias("idx", "c"))
        .where("c.n > 1").select("id", "h", "idx", "c.ch"))
    repeated = occurrences.groupBy("ch").agg(F.min(here).alias("first"), F.max(here).alias("last")).where("first != last")
    # Written, so that both sides of the join are plain shuffles, of which a very common chunk is split.
    repeated = written(repeated.select("ch", "first"), "line-chunks-repeated").hint("merge")
    found = occurrences.distinct().join(repeated, "ch")
    marked = written(
        found.groupBy("id", "h").agg(F.collect_list(F.struct("idx", "ch", "first")).alias("found"))
        .withColumnsRenamed({"id": "id_", "h": "h_"}), "line-chunks")
    # Grows with the corpus, so texts meet it by a shuffle join at every size.
    marked = marked.hint("merge")
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("h") == F.col("h_"))

    # Byte comparison: one text per hash, or the hash's occurrences are decided by text.
    texts = (
        chunked(rows.select("id", "h", "t").join(marked, same).select("id", "h", "t", "found"))
        .select("id", "h", "chunks", F.explode("found").alias("f"))
        .select("id", "h", "f.idx", "f.ch", F.expr("chunks[f.idx].text").alias("chunk")))
    by_text = texts.groupBy("ch", "chunk").agg(F.min(here).alias("first"))
    clashing = by_text.groupBy("ch").agg(F.count("*").alias("n")).where("n > 1").select("ch")
    clash = written(by_text.join(clashing, "ch"), "line-chunk-clashes")

    out = rows.select("row", "id", "h").join(marked, same, "left").drop("id_", "h_")
    if clash.isEmpty():
        out = out.withColumn("spared", F.lit(None).cast("array<int>"))
    else:
        first_of_text = texts.join(clash, ["ch", "chunk"]).where(here.eqNullSafe(F.col("first")))
        spared = first_of_text.groupBy("id", "h").agg(F.collect_set("idx").alias("spared"))
        out = out.join(spared.withColumnsRenamed({"id": "id_", "h": "h_"}), same, "left").drop("id_", "h_")
    # Of a hash with one text, all but the first occurrence go; of a clashing one, all but the first of each text.
    gone = F.filter("found", lambda f: ~F.struct("id", "h", f["idx"].alias("idx")).eqNullSafe(f["first"])
                    & ~F.coalesce(F.array_contains("spared", f["idx"]), F.lit(False)))
    gone = F.coalesce(F.transform(gone, lambda f: f["idx"]), F.array().cast("array<int>"))
    out = chunked(out.select("row", F.col("row")[text_col].cast("string").alias("t"), gone.alias("gone")))
    left = F.filter("chunks", lambda c, k: ~F.array_contains("gone", k))
    n_gone = F.aggregate(F.filter("chunks", lambda c, k: F.array_contains("gone", k)), F.lit(0), lambda a, c: a + c["n"])
    return out.select(
        "row", F.array_join(F.transform(left, lambda c: c["text"]), "\n").alias("text"),
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).alias("n_lines"),
        F.coalesce(n_gone, F.lit(0)).alias("n_removed"))


def op8_line_chunks(spark, sf_dir: str) -> DataFrame:
    out = dedup_line_chunks(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n_lines", "n_removed", "text")


ORACLE_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM {{documents}}
), vals AS (
  SELECT *, ('0x' || left(md5(line), 8))::BIGINT AS v FROM lines
), rolled AS (
  SELECT *, v + {BASE} * coalesce(lag(v) OVER (PARTITION BY doc_id ORDER BY i), 0) AS r, max(i) OVER (PARTITION BY doc_id) AS n FROM vals
), cuts AS (
  SELECT *, CASE WHEN i = n OR (i < n - 1 AND r < lag(r) OVER w AND r <= lead(r) OVER w) THEN 1 ELSE 0 END AS cut
  FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), placed AS (
  SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k
  FROM cuts
), chunks AS (
  SELECT doc_id, k, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n FROM placed GROUP BY doc_id, k
), judged AS (
  SELECT *, n > 1 AND row_number() OVER (PARTITION BY chunk, n > 1 ORDER BY doc_id, k) > 1 AS gone FROM chunks
), texts AS (
  SELECT doc_id, sum(n)::INTEGER AS n_lines, coalesce(sum(n) FILTER (WHERE gone), 0)::INTEGER AS n_removed,
    coalesce(string_agg(chunk, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS text
  FROM judged GROUP BY doc_id
)"""
OP8_SQL = ORACLE_SQL.format(documents="documents") + "\nSELECT doc_id, n_lines, n_removed, text FROM texts"
