import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starlens.llm.bpe import LONG, decode_documents, encode_digests, encode_documents, encoder, merge_long, merge_short, op9_bpe
from starlens.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()
OWN = encoder(PATH)


def reference(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(st.sampled_from("abcdeABC'st 12é\xa0\x85\x1cΣςİǅ́中!?<|startoftext|>"), max_size=30),
                 st.sampled_from(["a<|endoftext|>b", "<|startoftext|><|endoftext|>", "it's WE'LL don't", "ΑΣ ΑΣ.", "x" * 500, "ab!" * 300])))
def test_equals_the_library(text):
    ids, decoded = reference(text)
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == decoded


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("theinraot"), min_size=1, max_size=80))
def test_both_merges_agree(word):
    assert merge_short(list(word), OWN.ranks) == merge_long(list(word), OWN.ranks)


def test_long_word_takes_the_heap():
    word = "thein" * LONG
    assert OWN.encode(word) == reference(word)[0]


def test_documents_table(spark):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op9_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = table(spark, "/root/testdata/sf0.001", "documents").collect()
    for d in docs:
        ids, decoded = reference(d.text)
        assert got[d.doc_id] == (len(ids), sha(" ".join(map(str, ids))), sha(decoded))
    assert len(got) == len(docs)


def test_odd_rows_and_round_trip(spark):
    rows = [(1, None), (2, ""), (None, "Null Id"), (2, ""), (3, "tie"), (3, "tie"), (4, " \n ")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_tokens int, ids string")
    got = sorted(map(str, encode_digests(docs, PATH).collect()))
    assert len(got) == len(rows) and got.count(got[got.index(next(g for g in got if "id=3" in g))]) == 2
    encoded = encode_documents(docs, PATH)
    for r in encoded.collect():
        text = dict(rows)[r.id]
        assert r.ids == reference(text)[0]
    decoded = {r.id: r.text for r in decode_documents(encoded, PATH).collect()}
    assert decoded[None] == reference("Null Id")[1] and decoded[1] == ""
    assert encode_digests(docs.limit(0), PATH).count() == 0
