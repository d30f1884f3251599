"""Byte-level byte-pair encoding and decoding as a reduction over a monoid.

An element of the monoid is the encoding of a run of bytes.  A word (one match
of the pattern) is encoded by halves, down to leaves of ``LEAF`` bytes, and two
neighbours are joined at their seam: a window of the last tokens of the left
and the first tokens of the right is encoded anew, and grows on a side until
its outermost token there comes out unchanged.

This is a proof that all tokens outside have settled.  A sequence of tokens is
the encoding of its bytes exactly when every two neighbours are the encoding
of theirs: the first merge across any boundary would be chosen from those two
tokens alone, since up to then each is built as it is by itself, in the order
of ranks and from left to right.  Pairs within the window come from one
encoding, the pair across an unchanged outer token has not changed, and all
others were neighbours before.  So the join is exact and associative, for any
ranks.  A window that reaches the end of its side needs no check there.

Decoding concatenates the tokens' bytes up the same tree.  The file of ranks
(path a parameter) is read, never trained or copied.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import table

LEAF = 8  # bytes of a leaf, encoded directly
SEAM = 1  # tokens of each side in the first window of a join
NONE = 1 << 60  # of a pair without a rank
SCANNED = 64  # bytes up to which the smallest rank is found by scanning
MEMO_WORDS = 500_000  # words in each of the two generations that a worker remembers
MEMO_LEAVES = 200_000  # leaves that a worker remembers; words share many of them
MEMO_BYTES = 200  # longer words are not remembered


class ByteBpe:
    """Encoder and decoder by a file of ranks and a pattern for words."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError(f"{path}: not every byte has a rank")
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.words = regex.compile(pattern)
        self.memo, self.older, self.leaves = {}, {}, {}

    def direct(self, raw: bytes) -> list[bytes]:
        """Tokens of a leaf or window: the pair of least rank merges first, of
        equal ones the leftmost."""
        rank = self.ranks.get
        if len(raw) > SCANNED:
            return self._by_heap(raw)
        parts = [raw[i : i + 1] for i in range(len(raw))]
        ranks = [rank(raw[i : i + 2], NONE) for i in range(len(raw) - 1)]
        while ranks and (least := min(ranks)) < NONE:
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], NONE)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], NONE)
        return parts

    def _by_heap(self, raw: bytes) -> list[bytes]:
        """The same for long windows: a heap of (rank, start, end of the left, end of the right)."""
        n, rank = len(raw), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n))  # of the part that starts here; start of the one before
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if end[i] != j or j >= n or end[j] != k:
                continue  # one of the two has been merged since
            end[i], end[j] = k, -1
            if k < n:
                before[k] = i
                if (r := rank(raw[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, k, end[k]))
            if (h := before[i]) >= 0 and (r := rank(raw[h:k])) is not None:
                heapq.heappush(heap, (r, h, i, k))
        parts, i = [], 0
        while i < n:
            parts.append(raw[i : end[i]])
            i = end[i]
        return parts

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The monoid's product: tokens of the concatenated bytes."""
        if not left or not right:
            return left or right
        a, b = min(SEAM, len(left)), min(SEAM, len(right))
        while True:
            window = left[len(left) - a :] + right[:b]
            new = self.direct(b"".join(window))
            left_settled = a == len(left) or new[0] == window[0]
            right_settled = b == len(right) or new[-1] == window[-1]
            if left_settled and right_settled:
                return left[: len(left) - a] + new + right[b:]
            if not left_settled:
                a = min(2 * a, len(left))
            if not right_settled:
                b = min(2 * b, len(right))

    def encode_bytes(self, raw: bytes) -> list[bytes]:
        """Tokens of one word, by halves."""
        if len(raw) <= LEAF:
            found = self.leaves.get(raw)
            if found is None:
                found = self.leaves[raw] = self.direct(raw)
                if len(self.leaves) > MEMO_LEAVES:
                    self.leaves.clear()
            return found
        half = len(raw) // 2
        return self.join(self.encode_bytes(raw[:half]), self.encode_bytes(raw[half:]))

    def decode_bytes(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF:
            return b"".join([self.tokens[i] for i in ids])
        half = len(ids) // 2
        return self.decode_bytes(ids[:half]) + self.decode_bytes(ids[half:])

    def _entry(self, word: str) -> tuple[str, bytes]:
        found = self.older.get(word)
        if found is None:
            ids = [self.ranks[t] for t in self.encode_bytes(word.encode())]
            found = (",".join(map(str, ids)), self.decode_bytes(ids))
        if len(found[1]) <= MEMO_BYTES:
            if len(self.memo) >= MEMO_WORDS:
                self.memo, self.older = {}, self.memo
            self.memo[word] = found
        return found

    def entries(self, text: str | None) -> list[tuple[str, bytes]]:
        """(ids as decimals, decoded bytes) of each word."""
        out = []
        for w in self.words.findall(text or ""):
            out.append(self.memo.get(w) or self._entry(w))
        return out

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for e in self.entries(text) for i in e[0].split(",")]

    def decode(self, ids: list[int]) -> bytes:
        return self.decode_bytes(ids)


_loaded: dict[tuple[str, str], ByteBpe] = {}


def encoder(path: str, pattern: str) -> ByteBpe:
    """One encoder per worker process, file and pattern."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBpe(path, pattern)
    return _loaded[path, pattern]


def _mapped(docs: DataFrame, value: str, schema: str, run: Callable) -> DataFrame:
    def batches(bs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bs:
            yield run(b)

    return docs.select("id", value).mapInArrow(batches, f"id {docs.schema['id'].dataType.simpleString()}, {schema}")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): every whole text as token ids, one row per input row.

    A null or empty text gives an empty list; rows that repeat or have a null
    id each give a row; an empty table gives none.  A text may be one word of
    any length: time grows with n log n times the log of a window, and no word
    is cut.  Other columns are not read, so their names cannot clash."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(ranks_path, pattern)
        ids = pa.array((enc.encode(t.as_py()) for t in b.column(1)), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([b.column(0), ids], ["id", "ids"])

    return _mapped(_texts(docs, id_col, text_col), "t", "ids array<int>", run)


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(id, body): the bytes that the ids of (id, ids) stand for; null ids give null."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(ranks_path, pattern)
        bodies = pa.array((None if x.as_py() is None else enc.decode(x.as_py()) for x in b.column(1)), pa.binary())
        return pa.RecordBatch.from_arrays([b.column(0), bodies], ["id", "body"])

    return _mapped(encoded, "ids", "body binary", run)


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in
    one pass, without moving the ids.  Same rules as ``encode_documents``."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(ranks_path, pattern)
        n, ids, bodies = [], [], []
        for t in b.column(1):
            words = enc.entries(t.as_py())
            joined = ",".join([w[0] for w in words])
            n.append(joined.count(",") + 1 if joined else 0)
            ids.append(hashlib.sha256(joined.encode()).hexdigest())
            bodies.append(hashlib.sha256(b"".join([w[1] for w in words])).hexdigest())
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(bodies, pa.string())],
                                          ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _mapped(_texts(docs, id_col, text_col), "t", "n_tokens long, ids_sha256 string, decoded_sha256 string", run)


def op11_tree_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.withColumnRenamed("id", "doc_id")
