"""Repeated passages by a sparse suffix array.

Of the suffixes of all texts (in words) only those that start at a minimiser
are kept: the position of the smallest hash of ``GRAM`` words among ``WINDOW``
consecutive ones.  Equal passages select equal positions, so a passage of
``MIN_WORDS`` words or more that occurs twice holds a kept suffix within its
first ``WINDOW`` words, and the two suffixes agree in at least
``ROOT = MIN_WORDS - WINDOW + 1`` words.

Every window of ``MIN_WORDS`` words belongs to the kept suffix chosen among its
first ``WINDOW`` words, and equal windows to suffixes of an equal root.  The
windows of a suffix are one run of at most ``WINDOW`` starts; the words of all
of them are the suffix's context, all that decides about it.

1. Roots are counted by a hash of their words, which only rules out suffixes
   whose root occurs once; suffixes of an equal context (by a 128-bit BLAKE2b
   digest of its bytes) are one row from then on, and repeat each other whole.
2. Where the contexts of a root vary, a context's suffixes that start at its
   windows are sorted, by root and the digest of the window's bytes, over range
   partitions, and each is compared with its neighbours; the rows at the ends
   of partitions are compared in a second step, so that a window which very
   many contexts share is split over tasks.  A plain neighbour of the kept
   suffix would not do: the longest matches to its left and to its right may
   belong to different partners.
3. A context and its neighbour are aligned at the root and compared word by
   word, to the right and to the left, against this one partner; a span is
   formed of the windows that lie in both matches.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import table, written

MIN_WORDS = 50
WINDOW = 26
GRAM = 6
ROOT = MIN_WORDS - WINDOW + 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Spans:
    """Hashes of any run of words of one text."""

    def __init__(self, words: list[bytes]) -> None:
        n = len(words)
        self.n = n
        h = _mixed(np.fromiter(map(zlib.crc32, words), np.uint64, n) + np.uint64(1))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(h * _powers(_ODD, n))])
        self.back = _powers(_INVERSE, n + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = (end - start).astype(np.uint64)
        return _mixed((self.sums[end] - self.sums[start]) * self.back[start] + size * _ODD)


def _chosen(spans: Spans) -> np.ndarray:
    """For each run of WINDOW starts of GRAM words, the place of its smallest hash."""
    start = np.arange(spans.n - GRAM + 1)
    grams = spans.hash(start, start + GRAM)
    least = np.lib.stride_tricks.sliding_window_view(grams, WINDOW).argmin(axis=1)
    return least + np.arange(len(least))


def kept(spans: Spans) -> np.ndarray:
    """Positions of the kept suffixes that have ROOT words or more."""
    if spans.n < MIN_WORDS:
        return np.zeros(0, np.int64)
    at = np.unique(_chosen(spans))
    return at[at + ROOT <= spans.n]


def windows(spans: Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at, first, n): the kept suffixes that a window of MIN_WORDS words
    belongs to, and the run of its windows' starts, first to first + n - 1."""
    if spans.n < MIN_WORDS:
        return (np.zeros(0, np.int64),) * 3
    return np.unique(_chosen(spans)[: spans.n - MIN_WORDS + 1], return_index=True, return_counts=True)


def _occurrences(docs: DataFrame) -> DataFrame:
    """(id, h, at, first, n, root, context): each kept suffix and the run of
    its windows' starts; context is the digest of the bytes of all their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, ats, firsts, counts, roots, contexts = [], [], [], [], [], []
            for i, t in enumerate(b.column(2)):
                words = (t.as_py() or "").encode().split()
                spans = Spans(words)
                at, first, n = windows(spans)
                rows.append(np.full(len(at), i))
                ats.append(at)
                firsts.append(first)
                counts.append(n)
                roots.append(spans.hash(at, at + ROOT))
                if len(at):
                    text, start = _joined(words)
                    contexts += [_digest(text[start[f] : start[f + k + MIN_WORDS - 1] - 1]) for f, k in zip(first.tolist(), n.tolist())]
            which = pa.array(np.concatenate(rows or [np.zeros(0, np.int64)]).astype(np.int64))
            join = lambda parts, kind: np.concatenate(parts or [np.zeros(0, kind)]).astype(kind, copy=False)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(which), b.column(1).take(which), *(pa.array(join(x, np.int32)) for x in (ats, firsts, counts)),
                pa.array(join(roots, np.uint64).view(np.int64)), pa.array(contexts, pa.binary())],
                ["id", "h", "at", "first", "n", "root", "context"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "h", "t").mapInArrow(run, f"id {kind}, h long, at int, first int, n int, root long, context binary")


def _joined(words: list[bytes]) -> tuple[bytes, list[int]]:
    """The words with a space between them, and where each begins (and would begin)."""
    start = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=start[1:])
    return b" ".join(words), start.tolist()


def _digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def common_words(a: list, b: list) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def extended(own: list, lead: int, other: list, other_lead: int) -> tuple[int, int]:
    """(first, last) of the windows of ``own`` that ``other`` holds too, both
    aligned at the words ``lead`` and ``other_lead``; last < first if none."""
    right = common_words(own[lead:], other[other_lead:])
    left = common_words(own[:lead][::-1], other[:other_lead][::-1])
    return lead - left, min(lead + right - MIN_WORDS, lead)


CLASS = ["root", "context"]


def _neighbours(cuts: DataFrame) -> DataFrame:
    """(root, context, partner): for each window of a context that another
    context of its root holds too, one such context, its neighbour in sorted
    order.  ``cuts`` holds (root, context, window), written."""
    order = ["root", "window", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["root", "window", "context", "partner", "edge"]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
        last = None  # the row before
        for b in batches:
            if not b.num_rows:
                continue
            root, window, context = b.column(0).to_numpy(), b.column(1), b.column(2)
            key = np.frombuffer(window.buffers()[2], "V16", count=window.offset + len(window))[window.offset :]
            same = np.append(False, (root[1:] == root[:-1]) & (key[1:] == key[:-1]))
            ctx = context.to_pylist()
            out: list[tuple] = []
            if last is None:
                out.append((int(root[0]), window[0].as_py(), ctx[0], None, True))
            elif last[:2] == (int(root[0]), window[0].as_py()):
                out += [(*last[:3], ctx[0], False), (int(root[0]), window[0].as_py(), ctx[0], last[2], False)]
            at = np.flatnonzero(same)
            for i in at.tolist():  # each with the one before it; the one before, if it begins its run, with this
                out.append((int(root[i]), None, ctx[i], ctx[i - 1], False))
                if not same[i - 1]:
                    out.append((int(root[i]), None, ctx[i - 1], ctx[i], False))
            last = (int(root[-1]), window[len(ctx) - 1].as_py(), ctx[-1])
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], names)
        if last:
            yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip((*last, None, True), kinds)], names)

    ordered = cuts.repartitionByRange(*order).sortWithinPartitions(*order)
    met = written(ordered.select(*order).mapInArrow(run, "root long, window binary, context binary, partner binary, edge boolean"), "suffix-neighbours")
    ends = met.where("edge").groupBy("root", "window").agg(F.min("context").alias("low"), F.max("context").alias("high")).where("low <> high")
    ends = ends.select("root", F.explode(F.array(
        F.struct(F.col("low").alias("context"), F.col("high").alias("partner")), F.struct(F.col("high").alias("context"), F.col("low").alias("partner")))).alias("x"))
    return met.where("NOT edge").select(*CLASS, "partner").unionByName(ends.select("root", "x.context", "x.partner")).distinct()


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, spans): the documents that hold a passage of MIN_WORDS words or
    more which occurs again, in another document or in the same one; h is the
    text's xxhash64, spans the merged (start, end) in words (runs of characters
    other than ASCII white space), end exclusive, ascending.

    A span is a union of runs of MIN_WORDS words that each occur twice, runs
    that overlap or touch being one; text that only looks repeated because its
    left and its right stand in different places is none.  Rows equal in id and
    text are one document and no repeat of each other.  Null, empty and shorter
    texts hold no passage; a null id is kept.  A very long text is one row: its
    suffixes are rows of their own, and only its contexts of repeated roots are
    cut from it, in one task.  An empty table gives no rows; other columns are
    not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).withColumn("h", F.xxhash64("t"))
    occurrences = written(_occurrences(rows), "suffixes")
    here = F.xxhash64("id", "h", "at")
    roots = occurrences.groupBy("root").agg(
        F.min(here).alias("a"), F.max(here).alias("b"), F.min("context").alias("c"), F.max("context").alias("d"))
    # Written, so that both sides of the join are plain shuffles and a very common root is split.
    roots = written(roots.where("a <> b").select("root", (F.col("c") != F.col("d")).alias("varied")), "suffix-roots")
    repeated = written(occurrences.join(roots, "root"), "suffixes-repeated")

    # Where contexts vary, one suffix of each is cut from its text.
    contexts = repeated.where("varied").groupBy(*CLASS).agg(
        F.min(here).alias("a"), F.max(here).alias("b"), F.min(F.struct("id", "h", "at", "first", "n")).alias("one"))
    contexts = written(contexts, "suffix-contexts")
    asked = contexts.groupBy(F.col("one.id").alias("id_"), F.col("one.h").alias("h_")).agg(
        F.collect_list(F.struct(F.col("one.at").alias("at"), F.col("one.first").alias("first"), F.col("one.n").alias("n"), *CLASS)).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, asked in zip(b.column(0), b.column(1)):
                words, found = (text.as_py() or "").encode().split(), asked.as_py()
                raw, start = _joined(words)
                for at in range(0, len(found), 1024):
                    some = found[at : at + 1024]
                    digests = [[_digest(raw[start[i] : start[i + MIN_WORDS] - 1]) for i in range(x["first"], x["first"] + x["n"])] for x in some]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([x["root"] for x in some], pa.int64()), pa.array([x["context"] for x in some], pa.binary()),
                        pa.array([x["at"] - x["first"] for x in some], pa.int32()),
                        pa.array([raw[start[x["first"]] : start[x["first"] + x["n"] + MIN_WORDS - 1] - 1] for x in some], pa.binary()),
                        pa.array(digests, pa.list_(pa.binary()))], [*CLASS, "lead", "body", "windows"])

    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("h") == F.col("h_"))
    one_text = rows.join(asked, same).select("t", "asked")
    cuts = one_text.mapInArrow(cut, "root long, context binary, lead int, body binary, windows array<binary>")
    cuts = written(cuts.dropDuplicates(CLASS), "suffix-windows")  # a row that repeats is cut each time
    pairs = _neighbours(cuts.select(*CLASS, F.explode("windows").alias("window")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [extended(own.split(), lead, other.split(), other_lead) for lead, own, other_lead, other in
                     zip(*(b.column(c).to_pylist() for c in range(2, 6)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([f[k] for f in found], pa.int32()) for k in (0, 1))],
                                             [*CLASS, "low", "high"])

    bodies = cuts.select(*CLASS, "lead", "body")
    aligned = pairs.join(bodies, CLASS).join(
        bodies.select("root", F.col("context").alias("partner"), F.col("lead").alias("lead_"), F.col("body").alias("body_")), ["root", "partner"])
    spans_of = aligned.select(*CLASS, "lead", "body", "lead_", "body_").mapInArrow(verify, "root long, context binary, low int, high int")
    # The repeated windows of a suffix all hold its root, so they overlap and are one span.
    matches = spans_of.where("low <= high").groupBy(*CLASS).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    twin = contexts.select(*CLASS, (F.col("a") != F.col("b")).alias("twin"))
    matches = written(twin.join(matches, CLASS, "left").where("twin OR low IS NOT NULL"), "suffix-matches")
    spans = repeated.join(matches, CLASS, "left")
    whole = ~F.col("varied") | F.col("twin")  # an equal context stands elsewhere
    spans = spans.select(
        "id", "h", (F.col("first") + F.when(whole, 0).otherwise(F.col("low"))).alias("start"),
        (F.col("first") + F.when(whole, F.col("n") - 1).otherwise(F.col("high")) + MIN_WORDS).alias("end")).where("start IS NOT NULL")
    spans = spans.groupBy("id", "h").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    joined = F.aggregate("spans", F.array().cast("array<struct<start:int,end:int>>"), lambda done, s: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))))
    ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    return spans.select("id", "h", joined.alias("spans"))


def op5_suffixes(spark, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.size("spans").alias("n_spans"),
        F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"]).alias("n_words"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"))
