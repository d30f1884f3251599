import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starlens.llm.common import table
from starlens.llm import planes
from starlens.llm.planes import Encoder, crc_joined, op2_planes, pack, read_documents, unpack, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
MEMO = Encoder(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def expected(rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = np.array(ids_of(text) + [0], "<u4").tobytes()
        out.append((doc, start, len(raw) // 4, zlib.crc32(raw)))
        start += len(raw) // 4
    return out


@pytest.mark.parametrize("bits", [True, False])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000, 1 << 16])
def test_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4")
    assert (unpack(pack(ids, bits)) == ids).all()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab A.,!_'s1 \n\t é²ª\xa0\x85\x1cΣ中<|endoftext|>"), max_size=20), max_size=6),
       st.booleans())
def test_encoder_equals_the_library(texts, special):
    import pyarrow as pa

    texts = [t + "<|endoftext|>" * special for t in texts] + [None, ""]
    for text, got in zip(texts, MEMO.batch(pa.array(texts, pa.string()))):
        assert got.tolist() == ids_of(text)


def test_documents_table(spark):
    got = sorted(tuple(r) for r in op2_planes(spark, "/root/testdata/sf0.001").collect())
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    assert got == expected(docs)


@pytest.mark.parametrize("bits", [True, False])
def test_odd_rows(spark, bits):
    rows = [(3, "one two, three.\n\nfour"), (None, "null id"), (1, None), (2, ""), (5, "x " * 5000), (4, "<|endoftext|> a"), (6, "Σ中 é")]
    docs = spark.createDataFrame([(a, b, i, "x") for i, (a, b) in enumerate(rows)], "doc_id long, text string, part int, id string")
    chunks = write_tokens(docs, PATH, block=64, bits=bits)  # the long text spans many chunks
    assert {len(r.pieces) > 0 for r in chunks.collect()} == {True}
    got = [tuple(r) for r in read_documents(chunks).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(rows)


def test_repeated_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b c d")], "doc_id long, text string")
    got = read_documents(write_tokens(docs, PATH)).collect()
    assert sorted(r.n_tokens for r in got) == [2, 2, 4] and sorted(r.start for r in got)[0] == 0
    assert sum(r.n_tokens for r in got) == 8
    assert read_documents(write_tokens(docs.limit(0), PATH)).count() == 0


def test_checksums_of_pieces_join():
    rng = np.random.default_rng(6)
    for n, m in ((0, 0), (1, 0), (0, 9), (5, 4), (1000, 70_001)):
        a, b = rng.bytes(n), rng.bytes(m)
        assert crc_joined(zlib.crc32(a), zlib.crc32(b), m) == zlib.crc32(a + b)


def test_a_memo_that_shrinks_and_clashes_changes_nothing(monkeypatch):
    """Words are forgotten, and hashes of few values clash nearly always."""
    import pyarrow as pa

    real = planes.word_hashes
    for cached, of in ((40, real), (40, lambda w: real(w) % np.uint64(7)), (1 << 20, lambda w: real(w) % np.uint64(50))):
        monkeypatch.setattr(planes, "CACHED_WORDS", cached)
        monkeypatch.setattr(planes, "word_hashes", of)
        monkeypatch.setattr(planes, "_HASHED", 16)
        enc, rng = Encoder(PATH), np.random.default_rng(2)
        for _ in range(12):
            texts = [" ".join(rng.choice(["alpha", "Größe", "x1", "don't", "\nnew", ".", "a,b", "µm"]) + str(rng.integers(0, 40)) * int(rng.integers(0, 2))
                              for _ in range(30)) for _ in range(6)]
            for text, got in zip(texts, enc.batch(pa.array(texts, pa.string()))):
                assert got.tolist() == ids_of(text)
        assert cached > 40 or len(enc.memo.words) < 400
