"""Token ids in chunks of bit-plane-shuffled, zstandard-compressed blocks.

A chunk holds a fixed number of ids (the last one of a part may hold fewer).
Its payload is self-contained::

    magic "TPL1" | n_ids u32 | id bytes u8 | plane kind u8 (0 byte, 1 bit) | n_planes u16
    | compressed length of each plane u32 | planes

Byte plane k holds byte k of every id; bit plane k holds bit k of every id,
packed eight to a byte, so the planes of high bits are nearly constant and
compress away.  Byte planes are the default: on these ids they come out
smaller than bit planes and are packed several times as fast.  Chunks are rows (part, chunk, n_ids, payload, pieces) of a
table that Spark writes to the shared folder, so its commit protocol covers
lost executors; ``pieces`` is the chunk's index of documents.  Parts follow
the order of ids, and a prefix sum over the part totals gives every document
its global position.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlens.llm.bpe import byte_symbols
from starlens.llm.common import arrow_rows, written

MAGIC = b"TPL1"
BLOCK = 1 << 16  # ids in a chunk
END_ID = 0
SLICE = 6 << 20  # bytes of text encoded together, or one document
ROWS = 2000  # documents handed to Python at once
CACHED_WORDS = 1_500_000  # encoded words that a worker remembers; beyond, those met lately stay
_HASHED = 1 << 20  # bytes of words hashed at once
_HEAD = struct.Struct("<4sIBBH")


def pack(ids: np.ndarray, bits: bool = False, width: int = 4, level: int = 1) -> bytes:
    """The payload of one chunk of unsigned ids of ``width`` bytes."""
    raw = np.ascontiguousarray(ids, dtype=f"<u{width}").view(np.uint8).reshape(-1, width)
    if bits:
        planes = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        planes = raw.T
    zip_ = zstandard.ZstdCompressor(level=level)
    packed = [zip_.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
    sizes = np.array([len(p) for p in packed], dtype="<u4").tobytes()
    return _HEAD.pack(MAGIC, len(raw), width, int(bits), len(packed)) + sizes + b"".join(packed)


def unpack(payload: bytes) -> np.ndarray:
    magic, n, width, bits, n_planes = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a chunk of token planes")
    sizes = np.frombuffer(payload, "<u4", n_planes, _HEAD.size)
    at, planes, unzip = _HEAD.size + 4 * n_planes, [], zstandard.ZstdDecompressor()
    for size in sizes:
        planes.append(np.frombuffer(unzip.decompress(payload[at : at + size]), np.uint8))
        at += int(size)
    if not n:
        return np.zeros(0, dtype=f"<u{width}")
    grid = np.stack(planes)
    if bits:
        grid = np.packbits(np.unpackbits(grid, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little")
    else:
        grid = grid.T
    return np.ascontiguousarray(grid).view(f"<u{width}").ravel()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(words: pa.StringArray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    odd = 0x9E3779B97F4A7C15
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    out, at = np.empty(len(words), np.uint64), 0
    while at < len(words):
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + _HASHED, "right")) - 1)
        a, b = ends[at], ends[upto]
        if (b - a) >= len(_ahead[0]):
            _ahead[0], _ahead[1] = _powers(odd, int(b - a) + 2), _powers(pow(odd, -1, 1 << 64), int(b - a) + 2)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * _ahead[0][: b - a], out=sums[1:])
        start, end = ends[at:upto] - a, ends[at + 1 : upto + 1] - a
        h = (sums[end] - sums[start]) * _ahead[1][start]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        out[at:upto] = h ^ (h >> np.uint64(29))
        at = upto
    return out


_ahead = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # powers of the hash's base and of its inverse


class Memo:
    """Encoded words in compact arrays, found by a sorted table of hashes that
    is only added to; a word found by its hash is compared by its bytes."""

    def __init__(self, line_end: int) -> None:
        """The words as one Arrow array, their ids end to end, and where each word's ids end."""
        self.words = pa.array(["", "\n"])
        self.ids, self.ends = np.array([line_end], dtype="<u4"), np.array([0, 1])
        self.met = np.ones(2, bool)  # since the memo last shrank
        self._table()

    def _table(self) -> None:
        hashes = word_hashes(self.words)
        self.place = np.argsort(hashes, kind="stable").astype(np.int32)
        self.hashes = hashes[self.place]

    def find(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the memo or -1, hash) of each word."""
        hashes = word_hashes(words)
        order = np.argsort(hashes)
        at = np.empty(len(hashes), np.int64)
        at[order] = np.minimum(np.searchsorted(self.hashes, hashes[order]), len(self.hashes) - 1)
        place = self.place[at].copy()
        place[(self.hashes[at] != hashes) | ~pc.equal(self.words.take(pa.array(place)), words).to_numpy(zero_copy_only=False)] = -1
        self.met[place[place >= 0]] = True
        return place, hashes

    def add(self, words: pa.StringArray, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.hashes, hashes[order], "right")
        self.place = np.insert(self.place, at, (len(self.words) + order).astype(np.int32))
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.words = pa.concat_arrays([self.words, words])
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.met = np.concatenate([self.met, np.ones(len(words), bool)])

    def shrink(self) -> None:
        """Forget the words not met since the memo last shrank, and of the
        others the older ones beyond half of the bound."""
        keep = self.met.copy()
        keep[:2] = True
        keep[2:] &= np.cumsum(keep[:1:-1])[::-1] <= CACHED_WORDS // 2
        sizes = np.diff(self.ends, prepend=0)
        self.ids, self.words = self.ids[np.repeat(keep, sizes)], self.words.filter(pa.array(keep))
        self.ends, self.met = np.cumsum(sizes[keep]), np.zeros(int(keep.sum()), bool)
        self._table()


class Encoder:
    """The tokenizers library, with a memo of words.

    A byte-level tokenizer encodes each pre-token by itself.  A text without
    odd places is cut before every space, line end, comma and full stop, where
    its pattern always cuts too; equal pieces of a batch are found by Arrow's
    dictionary encoding, and the library encodes each piece that the worker
    has not met, a run of letters by its model, as it is one pre-token.  A text with an odd place (white space next to white space,
    punctuation runs before a comma or stop, characters outside Latin-1, the
    string of a special token) goes to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.odd = "|".join([
            r"^[.,\s]| $", r"[^\pL\pN][.,]", r"  | \n|\n[ \n]", r"[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}]", r"[^\x00-\x{ff}]",
            *map(re.escape, special)])
        self.line_end = self.library.encode("\n", add_special_tokens=False).ids[0]
        self.symbols = {b: c for b, c in enumerate(byte_symbols())}
        self.memo = Memo(self.line_end)

    def _learn(self, words: pa.StringArray, hashes: np.ndarray) -> np.ndarray:
        """Encode words and append them to the memo; their places in it."""
        new, tokenize = words.to_pylist(), self.library.model.tokenize
        # A run of letters is one pre-token; other words are cut by the library itself.
        one = np.fromiter(((w[1:] if w[0] == "\n" else w).isalpha() for w in new), bool, len(new))
        order, flat, sizes = [], array("I"), array("I")  # words in the order in which they are encoded, and their ids
        for at in range(0, len(new), 1 << 16):
            letters = [i for i in range(at, min(at + (1 << 16), len(new))) if one[i]]
            raws = "\n".join([new[i][1:] if new[i][0] == "\n" else " " + new[i] for i in letters])
            written_as = raws.encode().decode("latin-1").translate(self.symbols).split(self.symbols[10])  # as in the vocabulary
            for i, word in zip(letters, written_as):
                got = [t.id for t in tokenize(word)]
                if word[0] != "\u0120":
                    got.insert(0, self.line_end)
                flat.extend(got)
                sizes.append(len(got))
            order += letters
        for headed in (True, False):
            group = [i for i in np.flatnonzero(~one).tolist() if (new[i][0] == "\n") == headed]
            for at in range(0, len(group), 64):  # the library is slower on longer strings
                some = group[at : at + 64]
                # Line ends show where a word begins, or, put after each, where it ends.
                text = "".join(new[i] if headed else new[i] + "\n" if new[i][0] in ",." else " " + new[i] + "\n" for i in some)
                got = self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids
                marks = [k for k, x in enumerate(got) if x == self.line_end]
                for a, b in zip(marks, [*marks[1:], len(got)]) if headed else zip([0, *(k + 1 for k in marks)], marks):
                    flat.extend(got[a:b])
                    sizes.append(b - a)
            order += group
        places = np.empty(len(new), np.int32)
        places[order] = len(self.memo.words) + np.arange(len(new), dtype=np.int32)
        self.memo.add(words.take(pa.array(order, pa.int64())), hashes[order], np.array(flat, "<u4"), np.array(sizes, np.int64))
        return places

    def batch(self, texts: pa.StringArray) -> list[np.ndarray]:
        """Ids of each text (null: none)."""
        if len(self.memo.words) > CACHED_WORDS:
            self.memo.shrink()
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.odd).to_pylist()
        plain = pc.if_else(pa.array(odd, pa.bool_()), "", texts)
        marked = pc.replace_substring(pc.binary_join_element_wise("\n", plain, ""), "\n", " \n")
        for stop in ",.":
            marked = pc.replace_substring(marked, stop, " " + stop)
        lists = pc.split_pattern(marked, " ")  # the first piece of each is empty
        coded, cuts = lists.flatten().dictionary_encode(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        del plain, marked, lists  # the batch's largest arrays
        place, hashes = self.memo.find(coded.dictionary)
        unknown = place < 0
        if unknown.any():
            place[unknown] = self._learn(coded.dictionary.filter(pa.array(unknown)), hashes[unknown])
        word = place[coded.indices.to_numpy()]
        del coded, unknown, place, hashes
        starts = np.concatenate([[0], self.memo.ends[:-1]]).astype(np.int32)
        n = (self.memo.ends - starts).astype(np.int32)[word]
        ends = np.cumsum(n, dtype=np.int32)  # a slice holds far fewer ids than 2^31
        at = np.repeat(starts[word] - (ends - n), n)
        at += np.arange(len(at), dtype=np.int32)
        ids, cuts = self.memo.ids[at], np.concatenate([[0], ends])[cuts]
        del word, starts, n, ends, at
        return [  # the first id of a plain text is that of the line end put before it
            ids[a + 1 : b] if not o else np.array(self.library.encode(t.as_py(), add_special_tokens=False).ids, dtype="<u4")
            for a, b, o, t in zip(cuts[:-1], cuts[1:], odd, texts)]


_loaded: dict[str, Encoder] = {}

_END = np.array([END_ID], dtype="<u4")
PIECE = pa.struct([("id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("from", pa.int32()), ("n", pa.int32()), ("seq", pa.int32())])
CHUNK = ("part int, chunk int, n_ids int, payload binary, "
         "pieces array<struct<id:bigint,at:bigint,n_tokens:bigint,from:int,n:int,seq:int>>")


def write_tokens(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                 block: int = BLOCK, bits: bool = False) -> DataFrame:
    """Encode whole texts in ascending id order, an end id after each, write
    the chunk table to the shared folder, and return it as read back.

    Null ids come first; ties of an id are ordered by the text's hash.  A null
    or blank text gives the end id alone.  An empty table gives no chunk.
    Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _loaded.get(vocab_path) or _loaded.setdefault(vocab_path, Encoder(vocab_path))
        held, pieces, part, chunk, at = np.zeros(0, "<u4"), [], None, 0, 0

        def encoded(b: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
            """Ids of documents, their ids end to end with the end ids, and where each ends."""
            size = pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(size) // SLICE, prepend=0)).tolist()
            for start, end in zip([0, *cuts], [*cuts, b.num_rows]):
                some = b.slice(start, end - start)
                if some.num_rows:
                    ids = enc.batch(some.column(2))
                    flat = np.concatenate([x for y in ids for x in (y, _END)])
                    yield some.column(1).to_pylist(), flat, np.cumsum([len(x) + 1 for x in ids])

        def flush(ids: np.ndarray) -> pa.RecordBatch:
            nonlocal chunk
            row = [pa.array([v], k) for v, k in (
                (part, pa.int32()), (chunk, pa.int32()), (len(ids), pa.int32()),
                (pack(ids, bits), pa.binary()), (pieces, pa.list_(PIECE)))]
            chunk += 1
            return pa.RecordBatch.from_arrays(row, ["part", "chunk", "n_ids", "payload", "pieces"])

        for b in batches:
            part = part if part is not None or not b.num_rows else b.column(0)[0].as_py()
            for docs_, flat, ends in encoded(b):
                room, start = len(held), 0  # ids in the open chunk; where the document begins in flat
                flat = np.concatenate([held, flat])
                taken = 0
                for doc, end in zip(docs_, ends.tolist()):
                    n, done, seq = end - start, 0, 0
                    while done < n:
                        some = min(block - room, n - done)
                        pieces.append((doc, at, n, room, some, seq))
                        room, done, seq = room + some, done + some, seq + 1
                        if room == block:
                            yield flush(flat[taken : taken + block])
                            taken, room, pieces = taken + block, 0, []
                    at, start = at + n, end
                held = flat[taken:].copy()
        if pieces:
            yield flush(held)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    order = [F.asc_nulls_first("id"), F.xxhash64("t")]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    with arrow_rows(docs.sparkSession, ROWS):
        return written(parts.select(F.spark_partition_id().alias("part"), "id", "t").mapInArrow(run, CHUNK), "tokens")


def _times(a: int, b: int) -> int:
    """The product of two polynomials modulo that of crc32, bits reflected."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def crc_joined(first: int, second: int, n: int) -> int:
    """The crc32 of two byte strings end to end, from theirs and the second's length."""
    power, shift = 1 << 23, 1 << 31  # x^8, and x^0
    while n:
        if n & 1:
            shift = _times(power, shift)
        power, n = _times(power, power), n >> 1
    return _times(shift, first) ^ second


def part_starts(chunks: DataFrame) -> DataFrame:
    """(part, start): ids before each part; a row per part."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return chunks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("start"))


def read_documents(chunks: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of each document, from the payloads.

    Every chunk is unpacked once.  Of a document that spans chunks, only the
    length and checksum of each piece meet, by its position, and are joined in
    order; its ids are never gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, payload, pieces in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                raw = memoryview(unpack(payload.as_py()).astype("<u4").tobytes())
                bodies = [raw[4 * p["from"] : 4 * (p["from"] + p["n"])] for p in pieces]
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(pieces), pa.int32()),
                    *(pa.array([p[k] for p in pieces], kind) for k, kind in
                      (("id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("seq", pa.int32()))),
                    pa.array([p["n"] for p in pieces], pa.int32()), pa.array([zlib.crc32(x) for x in bodies], pa.int64()),
                ], ["part", "id", "at", "n_tokens", "seq", "n", "crc"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crcs = []
            for pieces in b.column(4).to_pylist():
                crc = pieces[0]["crc"]
                for p in pieces[1:]:
                    crc = crc_joined(crc, p["crc"], 4 * p["n"])
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(4)), pa.array(crcs, pa.int64())],
                                             ["part", "id", "at", "n_tokens", "crc"])

    pieces = chunks.select("part", "payload", "pieces").mapInArrow(
        run, "part int, id long, at long, n_tokens long, seq int, n int, crc long")
    documents = pieces.groupBy("part", "id", "at", "n_tokens").agg(F.sort_array(F.collect_list(F.struct("seq", "n", "crc"))).alias("pieces"))
    rows = documents.mapInArrow(joined, "part int, id long, at long, n_tokens long, crc long")
    return rows.join(part_starts(chunks), "part").select(
        "id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32"))


def op2_planes(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from starlens.llm.common import table

    chunks = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(chunks).withColumnRenamed("id", "doc_id")
