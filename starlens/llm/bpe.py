"""Byte-pair encoding and decoding with word ends, by a contiguous rank array.

A word's parts are slices between boundaries; beside each boundary stands the
rank of merging the parts that meet there.  The smallest rank is found by
scanning, its boundary is deleted, and the two neighbouring ranks are
refreshed.  Words are short, so the scan beats any linked structure; words of
more than ``LONG`` symbols use a heap over the same boundaries, with the same
results, to stay out of quadratic time.

The vocabulary file (path a parameter) is read, never trained or copied.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = 1 << 60
LONG = 160
CACHED_WORDS = 300_000  # encoded words that a worker remembers; the memo is emptied beyond


def merge_short(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    rank = [ranks.get(p, NONE) for p in zip(parts, parts[1:])]
    while rank:
        least = min(rank)
        if least == NONE:
            break
        i = rank.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del rank[i]
        if i:
            rank[i - 1] = ranks.get((parts[i - 1], parts[i]), NONE)
        if i < len(rank):
            rank[i] = ranks.get((parts[i], parts[i + 1]), NONE)
    return parts


def merge_long(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    n = len(parts)
    part: list[str | None] = list(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 1) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]), NONE)) < NONE]
    heapq.heapify(heap)
    while heap:
        r, i, j = heapq.heappop(heap)
        if part[i] is None or part[j] is None or after[i] != j or ranks.get((part[i], part[j]), NONE) != r:
            continue  # one of the two has been merged since
        part[i], part[j] = part[i] + part[j], None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (s := ranks.get((part[i], part[k]), NONE)) < NONE:
                heapq.heappush(heap, (s, i, k))
        if (h := before[i]) >= 0 and (s := ranks.get((part[h], part[i]), NONE)) < NONE:
            heapq.heappush(heap, (s, h, i))
    return [p for p in part if p is not None]


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself if printable, else the next code point from 256 on."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class WordBpe:
    """Encoder and decoder of a lower-casing word-end BPE tokenizer file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError(f"{path}: not a word-end BPE vocabulary")
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): r for r, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.symbols = byte_symbols()
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        whole = Tokenizer.from_file(path)  # only its Unicode tables are used, for text outside Latin-1
        self.normalizer, self.pre_tokenizer = whole.normalizer, whole.pre_tokenizer
        self.memo: dict[str, tuple[int, str, str]] = {}

    def word(self, w: str) -> list[int]:
        """Ids of one word, given as text."""
        return self.symbols_ids([self.symbols[b] for b in w.encode()])

    def symbols_ids(self, parts: list[str]) -> list[int]:
        parts[-1] += self.end
        merged = merge_short(parts, self.ranks) if len(parts) <= LONG else merge_long(parts, self.ranks)
        return [self.vocab[p] for p in merged]

    def _entry(self, key: str, ids: list[int]) -> tuple[int, str, str]:
        out = (len(ids), " ".join(map(str, ids)), " ".join(self.tokens[i] for i in ids))
        if len(self.memo) >= CACHED_WORDS:
            self.memo.clear()
        if len(key) <= LONG:
            self.memo[key] = out
        return out

    def _plain(self, text: str) -> list[tuple[int, str, str]]:
        """Entries of a text without special tokens."""
        memo = self.memo
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            # The library's own Unicode tables decide on case, classes and composition.
            out = []
            for w, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text)):
                out.append(memo.get("\0" + w) or self._entry("\0" + w, self.symbols_ids(list(w))))
            return out
        text = unicodedata.normalize("NFC", text).lower()
        return [memo.get(w) or self._entry(w, self.word(w)) for w in self.words.findall(text)]

    def entries(self, text: str | None) -> list[tuple[int, str, str]]:
        """(number of ids, ids as decimals, decoded tokens) of each word."""
        text, out, at = text or "", [], 0
        if self.cut:
            for m in self.cut.finditer(text):
                i = self.special[m[0]]
                out += self._plain(text[at : m.start()])
                out.append((1, str(i), self.tokens[i]))
                at = m.end()
        return out + self._plain(text[at:])

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for e in self.entries(text) for i in e[1].split()]

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids, joined by a space (the file names no decoder)."""
        return " ".join(self.tokens[i] for i in ids)


_loaded: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """One encoder per worker process and file."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): every whole text as token ids.  A null or blank text gives
    an empty list; rows that repeat or have a null id each give a row; an
    empty table gives none.  Other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab_path)
        for b in batches:
            ids = pa.array((enc.encode(t.as_py()) for t in b.column(1)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], ["id", "ids"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(
        run, f"id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """(id, text) of (id, ids); null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab_path)
        for b in batches:
            texts = pa.array((None if x.as_py() is None else enc.decode(x.as_py()) for x in b.column(1)), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), texts], ["id", "text"])

    return encoded.mapInArrow(run, f"id {encoded.schema['id'].dataType.simpleString()}, text string")


def encode_digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in
    one pass, without moving the ids.  Same rules as ``encode_documents``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab_path)
        sha = lambda parts: hashlib.sha256(" ".join(parts).encode()).hexdigest()
        for b in batches:
            n, ids, texts = [], [], []
            for t in b.column(1):
                words = enc.entries(t.as_py())
                n.append(sum(w[0] for w in words))
                ids.append(sha([w[1] for w in words]))
                texts.append(sha([w[2] for w in words]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(
        run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from starlens.llm.common import table

    out = encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.withColumnRenamed("id", "doc_id")
