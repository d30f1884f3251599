import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from starlens.llm import treebpe
from starlens.llm.treebpe import ByteBpe, decode_documents, encode_digests, encode_documents, op11_tree_bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return ByteBpe(PATH, P.PATTERN)


def texts(n, seed):
    rng = random.Random(seed)
    alphabets = ["abcdefghijklmnop", "ab", "aaaaab", "0123456789", " \n\t.,!?'sdm", "äöüßéèà", "中文字符日本語", "😀😁👍🏽‍", "ัก็้ขค", "\x00\x7f  ﻿"]
    for _ in range(n):
        yield "".join("".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(1, 9))) if rng.random() < .7
                      else rng.choice(alphabets[rng.randint(0, 2)]) * rng.randint(1, 40) for _ in range(rng.randint(0, 12)))


def test_equals_library_on_fuzzed_texts(library, own):
    for t in texts(3000, 5):
        ids = own.encode(t)
        assert ids == library.encode_ordinary(t), t
        assert own.decode(ids) == t.encode()


@pytest.mark.parametrize("word", ["a" * 5001, "ab" * 3000, "abcabd" * 700 + "x", "é" * 999, "0" * 4097, " " * 3000, "\n" * 777, "aab" * 1001, "-" * 2500])
def test_long_words(library, own, word):
    """Windows of such runs grow far, as every boundary may shift."""
    assert own.encode(word) == library.encode_ordinary(word)
    assert own.decode(own.encode(word)) == word.encode()


def test_a_join_is_associative_and_exact(own):
    rng = random.Random(3)
    for _ in range(400):
        raw = "".join(rng.choice(["th", "e", "ing", "a", "aa", "ation", "é", "1"]) for _ in range(rng.randint(3, 40))).encode()
        i, j = sorted(rng.sample(range(len(raw) + 1), 2))
        a, b, c = (own.direct(x) for x in (raw[:i], raw[i:j], raw[j:]))
        want = own.direct(raw)
        assert own.join(own.join(a, b), c) == own.join(a, own.join(b, c)) == want == own._by_heap(raw)


def test_made_up_ranks_where_windows_grow_to_the_ends(tmp_path):
    """Ranks under which one more byte at either end shifts every boundary."""
    rng = random.Random(11)
    for trial in range(30):
        tokens = [bytes([b]) for b in range(256)]
        grown = [b"a", b"b"]
        for _ in range(25):  # each new token is a merge of two older ones
            new = rng.choice(grown) + rng.choice(grown)
            if new not in grown and len(new) < 40:
                grown.append(new)
        tokens += grown[2:]
        path = tmp_path / f"ranks{trial}"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
        enc = ByteBpe(str(path), P.PATTERN)
        for _ in range(60):
            raw = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 150)))
            if rng.random() < .3:
                raw = rng.choice([b"a", b"ab", b"aab"]) * rng.randint(1, 60)
            assert enc.encode_bytes(raw) == enc.direct(raw)


def test_memo_generations(library, monkeypatch):
    monkeypatch.setattr(treebpe, "MEMO_WORDS", 3)
    enc = ByteBpe(PATH, P.PATTERN)
    for t in [*texts(200, 8)] * 2:
        assert enc.encode(t) == library.encode_ordinary(t)
    assert len(enc.memo) <= 3 and len(enc.older) <= 3


def test_odd_rows(spark, library):
    long_text = "x" * 300_000 + " y" * 1000
    given = [(1, "two words", "c", 1), (None, "null id", "c", 2), (2, None, "c", 3), (3, "", "c", 4), (4, "same", "c", 5), (4, "same", "c", 5), (5, long_text, "c", 6)]
    docs = spark.createDataFrame(given, "doc_id long, text string, ids string, t int")
    got = sorted(encode_digests(docs, PATH, P.PATTERN).collect(), key=str)
    want = sorted(((i, len(ids := library.encode_ordinary(t or "")), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _, _ in given), key=lambda r: str(r))
    assert sorted(map(tuple, got), key=str) == want
    encoded = encode_documents(docs, PATH, P.PATTERN)
    assert {(r.id, tuple(r.ids)) for r in encoded.collect()} == {(i, tuple(library.encode_ordinary(t or ""))) for i, t, _, _ in given}
    back = decode_documents(encoded, PATH, P.PATTERN)
    assert sorted(((r.id, bytes(r.body).decode()) for r in back.collect()), key=str) == sorted(((i, t or "") for i, t, _, _ in given), key=str)
    assert decode_documents(encoded.selectExpr("id", "if(id = 1, null, ids) ids"), PATH, P.PATTERN).where("body is null").count() == 1
    assert encode_digests(docs.where("false"), PATH, P.PATTERN).count() == 0


def test_documents_table(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op11_tree_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
