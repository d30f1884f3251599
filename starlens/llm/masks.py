"""Ranked lexical search by presence-mask grouping.

Documents are cut into blocks, in the order in which they are read; of a block
only the postings of the items' terms are kept, as arrays by term.  For a
block and an item, the documents' masks of matched terms are built by setting
a bit for each of the item's terms over its postings; documents of equal mask
are a group, and a mask's maximum score is the sum of its terms' largest
contributions in the block.  Groups are evaluated exactly in descending order
of that maximum, and the rest is left once it lies below the item's last
place so far (equal scores still count, for the order of ids).

A task carries an item's best from block to block, which raises the bar early;
across tasks the lists are merged by a ranked window, which Spark limits
map-side.  Documents' statistics are sums over the blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlens.llm.common import arrow_rows, table, written

DOCS_BITS = 12  # 4096 documents in a block
POSTINGS = 1 << 21  # postings at which a block is closed early
ITEM_TERMS = 1 << 17  # terms of a packed row of items, or one item
BLOCKS = 16  # blocks of documents in a bucket, where there are enough of them
TILES = 4  # joined rows handed to Python at once
ROWS = 2500  # documents, or postings, handed to Python at once
HELD = 20_000  # items whose lists a task holds before it hands them on
#: The size up to which the items' vocabulary is broadcast; beyond, postings meet it by a shuffle.
HINTED_TERMS, HINTED_BYTES = 500_000, 16 << 20
_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII; only A-Z lower-cased."""
    return (text or "").encode().translate(_TO_LOWER).split()


def _counted(rows: DataFrame) -> DataFrame:
    """(key, id, term, tf) from (key, id, t): a row per distinct term, and one
    with the empty term whose tf is the number of all terms, if there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, counts, ends = [], [], [0]
            for t in b.column(2):
                found = terms(t.as_py())
                if found:
                    c = Counter(found)
                    words += [b"", *c]
                    counts += [len(found), *c.values()]
                ends.append(len(words))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.ListArray.from_arrays(ends, pa.array(words, pa.binary())),
                pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))], ["key", "id", "terms", "tfs"])

    with_lists = rows.mapInArrow(run, "key long, id long, terms array<binary>, tfs array<int>")
    return with_lists.select("key", "id", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select(
        "key", "id", F.col("x.terms").alias("term"), F.col("x.tfs").alias("tf"))


_BLOCK = "block long, n_docs int, ids binary, nameless binary, sizes binary, tids binary, ends binary, at binary, tf binary"


def _blocks(postings: DataFrame) -> DataFrame:
    """Rows (block, at, id, tid, tf), those of a document together and those
    of a block together, as packed blocks; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        kept = 0  # postings held

        def flush(some: list[pa.RecordBatch]) -> pa.RecordBatch:
            block, at, id_, tid, tf = (pa.chunked_array([b.column(c) for b in some]) for c in range(5))
            at, tid, tf = at.to_numpy(), tid.to_numpy(), tf.to_numpy()
            head = tid == 0  # the row with the document's number of terms
            docs, place = np.unique(at, return_inverse=True)
            own = np.full(len(docs), -1)
            own[place[head]] = np.flatnonzero(head)
            ids = id_.take(pa.array(own))
            order = np.lexsort((place[~head], tid[~head]))
            by_tid = tid[~head][order]
            tids, starts = np.unique(by_tid, return_index=True)
            parts = [pc.fill_null(ids, 0).to_numpy().astype("<i8"), pc.is_null(ids).to_numpy().astype("i1"),
                     tf[own].astype("<i8"), tids.astype("<i8"), np.append(starts, len(by_tid))[1:].astype("<i4"),
                     place[~head][order].astype("<i4"), tf[~head][order].astype("<i4")]
            row = [pa.array([block[0].as_py()], pa.int64()), pa.array([len(docs)], pa.int32()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)]
            return pa.RecordBatch.from_arrays(row, ["block", "n_docs", "ids", "nameless", "sizes", "tids", "ends", "at", "tf"])

        for b in batches:
            if not b.num_rows:
                continue
            block, at = b.column(0).to_numpy(), b.column(1).to_numpy()
            new_doc = np.append(True, (np.diff(block) != 0) | (np.diff(at) != 0))
            last = (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()) if held else None
            new_doc[0] = last is None or last != (block[0], at[0])
            new_block = np.append(last is not None and last[0] != block[0], np.diff(block) != 0)
            start = 0
            for i in np.flatnonzero(new_doc):
                if new_block[i] or kept + i - start >= POSTINGS:  # only between documents
                    if i > start:
                        held.append(b.slice(start, i - start))
                    if held:
                        yield flush(held)
                    held, start, kept = [], i, 0
            held.append(b.slice(start))
            kept += b.num_rows - start
        if held:
            yield flush(held)

    with arrow_rows(postings.sparkSession, ROWS):
        return written(postings.mapInArrow(run, _BLOCK), "search-blocks")


class _Block:
    """An opened block of documents."""

    def __init__(self, row: dict, n: int, total: int) -> None:
        read = lambda c, kind: np.frombuffer(row[c], kind)
        self.ids, self.nameless = read("ids", "<i8"), read("nameless", "i1")
        sizes, self.at, tf = read("sizes", "<i8"), read("at", "<i4"), read("tf", "<i4").astype(np.int64)
        if 25 * n * int(sizes.max(initial=0)) >= 1 << 62:
            sizes = sizes.astype(object)
        m = (75 + (25 * n * sizes) // total).astype(np.int64)
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[self.at])
        ends = read("ends", "<i4").tolist()
        self.spans = dict(zip(read("tids", "<i8").tolist(), zip([0, *ends[:-1]], ends)))
        self.largest: dict[int, int] = {}

    def largest_impact(self, tid: int) -> int:
        if tid not in self.largest:
            a, b = self.spans[tid]
            self.largest[tid] = int(self.impact[a:b].max())
        return self.largest[tid]


def search(block: _Block, query: list[tuple[int, int]], k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents' places, scores) of the block's documents that can be among
    the k best of a query of (term, weight times repeats), given that scores
    below ``bar`` cannot; documents of equal score as the last place are kept."""
    query = [(t, w) for t, w in query if w > 0 and t in block.spans]
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not query:
        return none
    words = -(-len(query) // 64)
    masks = np.zeros((words, len(block.ids)), np.uint64)
    for i, (t, _) in enumerate(query):
        a, b = block.spans[t]
        masks[i // 64, block.at[a:b]] |= np.uint64(1 << (i % 64))
    docs = np.flatnonzero(masks.any(axis=0) if words > 1 else masks[0])
    coded = masks[:, docs] if words > 1 else masks[0, docs]
    if words > 1:
        rows = np.ascontiguousarray(coded.T)
        distinct, group = np.unique(rows.view(np.dtype((np.void, 8 * words))).ravel(), return_inverse=True)
        distinct = distinct.view(np.uint64).reshape(-1, words)
    else:
        distinct, group = np.unique(coded, return_inverse=True)
        distinct = distinct[:, None]
    bits = np.unpackbits(distinct.astype("<u8").view(np.uint8), axis=1, count=len(query), bitorder="little")
    most = bits.astype(np.int64) @ np.array([w * block.largest_impact(t) for t, w in query], np.int64)
    order = np.argsort(-most, kind="stable")  # groups, the most promising first
    by_group, sizes = np.argsort(group, kind="stable"), np.bincount(group, minlength=len(order))
    starts = np.cumsum(sizes) - sizes
    reached = np.cumsum(sizes[order])
    slot = np.full(len(block.ids), -1, np.int64)
    at, kept, kept_scores, want = 0, *none, 4 * k
    while at < len(order) and most[order[at]] >= max(bar, 1):
        upto = min(len(order), max(at + 1, int(np.searchsorted(reached, reached[at - 1] + want if at else want, "right"))))
        some = [g for g in order[at:upto].tolist() if most[g] >= bar]
        chosen = docs[np.concatenate([by_group[starts[g] : starts[g] + sizes[g]] for g in some])]
        slot[chosen] = np.arange(len(chosen))
        score = np.zeros(len(chosen), np.int64)
        for i in np.flatnonzero(bits[some].any(axis=0)).tolist():
            t, w = query[i]
            a, b = block.spans[t]
            place = slot[block.at[a:b]]
            hit = place >= 0
            score[place[hit]] += w * block.impact[a:b][hit]
        slot[chosen] = -1
        kept, kept_scores = np.concatenate([kept, chosen]), np.concatenate([kept_scores, score])
        if len(kept) >= k:
            bar = max(bar, int(np.partition(kept_scores, len(kept) - k)[len(kept) - k]))
        at, want = upto, 2 * want
    good = (kept_scores >= bar) & (kept_scores > 0)
    return kept[good], kept_scores[good]


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a
    score above zero, best first, ties by ascending id (null ids last).

    The terms, weights and scores are those of the contract of op13.  A null
    or empty text has no term: as a document it counts for nothing, as an item
    it gives no rows.  Every row is a document, or an item, of its own, also
    if it repeats or shares an id: equal rows rank one behind the other.  A
    very long text is one document, whose postings are at most the items'
    vocabulary; a very long item has masks of several words.  Empty tables
    give no rows; other columns are not read.
    """
    asked = items.select(F.monotonically_increasing_id().alias("key"), F.col(item_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("t"))
    asked = written(_counted(asked), "search-items")
    # The empty term has number 0, the others follow in any order.
    vocabulary = asked.where("term != x''").select("term").distinct().select("term", (F.monotonically_increasing_id() + 1).alias("tid"))
    vocabulary = written(vocabulary.unionByName(docs.sparkSession.range(1).select(F.lit(b"").alias("term"), F.lit(0).cast("long").alias("tid"))), "search-terms")
    n_terms, n_bytes = vocabulary.agg(F.count("*"), F.sum(F.octet_length("term"))).first()

    given = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    block, at = F.shiftright("key", DOCS_BITS).alias("block"), F.col("key").bitwiseAND((1 << DOCS_BITS) - 1).cast("int").alias("at")
    named = F.when(F.col("tid") == 0, F.col("id")).alias("id")
    counted = _counted(given)
    if n_terms <= HINTED_TERMS and (n_bytes or 0) <= HINTED_BYTES:
        postings = counted.join(F.broadcast(vocabulary), "term").select(block, at, named, "tid", "tf")  # documents stay in place
    else:
        postings = counted.join(vocabulary, "term").select(block, at, named, "tid", "tf")
        postings = postings.repartition("block").sortWithinPartitions("block", "at")
    blocks = _blocks(postings)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for sizes, tids, ends in zip(*(b.column(c) for c in range(3))):
                sizes, tids, ends = np.frombuffer(sizes.as_py(), "<i8"), np.frombuffer(tids.as_py(), "<i8"), np.frombuffer(ends.as_py(), "<i4")
                yield pa.RecordBatch.from_arrays([  # the empty term: documents, and the sum of their terms
                    pa.array(np.append(0, tids)), pa.array(np.append(len(sizes), np.diff(ends, prepend=0)).astype(np.int64)),
                    pa.array(np.append(sizes.sum(), np.zeros(len(tids))).astype(np.int64))], ["tid", "df", "total"])

    df = blocks.select("sizes", "tids", "ends").mapInArrow(frequencies, "tid long, df long, total long").groupBy("tid").agg(
        F.sum("df").alias("df"), F.sum("total").alias("total"))
    df = written(df, "search-frequencies")
    n, total = df.where("tid = 0").select("df", "total").first() or (0, 1)

    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = written(vocabulary.join(df, "tid").where("tid > 0").select("term", "tid", weight.alias("w")), "search-weights")
    queries = asked.join(weights, "term").groupBy("key", "id").agg(F.collect_list(F.struct("tid", (F.col("w") * F.col("tf")).alias("w"))).alias("terms"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        names = ["items", "keys"]
        kinds = [pa.list_(pa.list_(pa.int64())), pa.list_(pa.int64())]
        for b in batches:
            for key, found in zip(b.column(0).to_pylist(), b.column(1)):
                flat = [v for x in found.as_py() for v in (x["tid"], x["w"])]
                held.append((flat, key))
                n_held += len(flat) // 2
                if n_held >= ITEM_TERMS:
                    yield pa.RecordBatch.from_arrays([pa.array([list(c)], kind) for c, kind in zip(zip(*held), kinds)], names)
                    held, n_held = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([list(c)], kind) for c, kind in zip(zip(*held), kinds)], names)

    packed = written(queries.select("key", "terms").mapInArrow(pack, "items array<array<long>>, keys array<long>"), "search-queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, bool, int]]] = {}

        def hand_on() -> pa.RecordBatch:
            flat = [(key, *e) for key, es in best.items() for e in es]
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in flat], kind) for c, kind in enumerate(kinds)],
                                              ["key", "neg", "nameless", "id"])

        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(j)[i].as_py() for j, c in enumerate(b.schema.names)}
                opened = _Block(row, n, total)
                for key, flat in zip(row["keys"], row["items"]):
                    held = best.get(key, [])
                    bar = -held[-1][0] if len(held) == k else 1
                    docs_, scores = search(opened, [*zip(flat[::2], flat[1::2])], k, bar)
                    if len(docs_):
                        found = zip((-scores).tolist(), opened.nameless[docs_].astype(bool).tolist(), opened.ids[docs_].tolist())
                        best[key] = sorted([*held, *found])[:k]
                if len(best) > HELD:
                    yield hand_on()
                    best = {}
        yield hand_on()

    n_blocks = blocks.count()
    buckets = max(-(-n_blocks // BLOCKS), min(n_blocks, docs.sparkSession.sparkContext.defaultParallelism), 1)
    dealt = blocks.withColumn("bucket", F.pmod(F.xxhash64("block", "ids"), F.lit(buckets)).cast("int"))
    sent = packed.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    tiles = dealt.join(sent, "bucket").drop("bucket", "block", "n_docs")
    with arrow_rows(docs.sparkSession, TILES):
        lists = written(tiles.mapInArrow(run, "key long, neg long, nameless boolean, id long"), "search-lists")
    place = F.row_number().over(Window.partitionBy("key").orderBy("neg", "nameless", "id"))
    first = lists.withColumn("rank", place).where(F.col("rank") <= k)
    return first.join(queries.select("key", F.col("id").alias("item_id")), "key").select(
        "item_id", F.col("rank").cast("int").alias("rank"), F.when(~F.col("nameless"), F.col("id")).alias("doc_id"), (-F.col("neg")).alias("score"))


def op13_masks(spark, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents
), sums AS (
  SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS total FROM d WHERE len(ts) > 0
), postings AS (
  SELECT r, doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY r, doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * (SELECT n_docs FROM sums) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings GROUP BY term
), asked AS (
  SELECT r, item_id, term, count(*) AS qtf FROM (SELECT row_number() OVER () AS r, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY r, item_id, term
), scored AS (
  SELECT a.r AS ar, a.item_id, p.r, p.doc_id,
    sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // total))))::BIGINT AS score
  FROM asked a JOIN weights USING (term) JOIN postings p USING (term), sums GROUP BY a.r, a.item_id, p.r, p.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20"""
