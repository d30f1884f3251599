import random
import zlib

import pytest

from starlens.llm.suffixes import MIN_WORDS, Spans, extended, kept, op5_suffixes, repeated_passages


def covered(texts):
    """Words inside some run of MIN_WORDS words that occurs twice."""
    seen, docs = {}, [(t or "").split() for t in texts]
    for d, w in enumerate(docs):
        for i in range(len(w) - MIN_WORDS + 1):
            seen.setdefault(tuple(w[i : i + MIN_WORDS]), []).append((d, i))
    return {(d, i + k) for at in seen.values() if len(at) > 1 for d, i in at for k in range(MIN_WORDS)}


def spans(texts):
    """The covered words of each text as runs."""
    out = {}
    for d, k in sorted(covered(texts)):
        runs = out.setdefault(d, [])
        if runs and runs[-1][1] >= k:
            runs[-1] = (runs[-1][0], k + 1)
        else:
            runs.append((k, k + 1))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = lambda n: " ".join(f"w{rng.randint(0, 9999)}é" for _ in range(n))
    passages = [words(n) for n in (50, 51, 60, 90, 300, 40, 26)]
    out = [" ".join(filter(None, (words(rng.randint(0, 40)), p, words(rng.randint(0, 40))))) for p in passages for _ in range(4)]
    whole = words(200)
    changed = whole.split()
    changed[100] = "changed"
    out += [whole, whole, " ".join(changed), words(400), words(20), "a b " * 100, words(60) + "\n" + whole]
    twice = words(55)
    return out + [f"{twice} {words(30)} {twice}"]


def run(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, at int, root string")
    return {r.id: [(s.start, s.end) for s in r.spans] for r in repeated_passages(docs).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    texts = corpus(seed)
    got = run(spark, list(enumerate(texts)))
    assert got == spans(texts)
    n = 28  # documents around passages; the last of these are shorter than MIN_WORDS
    assert not any(d in got for d in range(5 * 4, n)) and 31 not in got  # short passages and fresh text stay out


def test_kept_positions_of_equal_words_are_equal():
    rng = random.Random(5)
    w = [b"%d" % rng.randint(0, 99) for _ in range(400)]
    a, b = kept(Spans(w)), kept(Spans([b"x"] * 7 + w))
    inner = {int(p) for p in a if 40 < p < 350}
    assert inner == {int(p) - 7 for p in b if 47 < p < 357} and len(inner) > 10


def test_odd_rows(spark):
    p = " ".join(f"v{i}" for i in range(70))
    rows = [(None, p), (1, "x " + p), (2, None), (3, ""), (4, p[:50]), (5, p + " end"), (5, p + " end"), (6, "solo " * 3)]
    got = run(spark, rows)
    assert got == {None: [(0, 70)], 1: [(1, 71)], 5: [(0, 70)]}
    same = " ".join(f"u{i}" for i in range(80))
    assert run(spark, [(1, same), (1, same)]) == {}  # one document, given twice
    assert run(spark, [(1, same), (2, same)]) == {1: [(0, 80)], 2: [(0, 80)]}
    assert run(spark, []) == {}


def test_documents_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in op5_suffixes(spark, sf).collect()}
    want = spans([d.text for d in docs])
    assert {d: r.spans for d, r in got.items()} == {docs[d].doc_id: ",".join(f"{a}-{b}" for a, b in s) for d, s in want.items()}


def test_both_ends_of_a_span_have_the_same_partner(spark):
    """Boilerplate of 40 words, its left shared with one document and its
    right with another, is no passage of 50; spans equal brute force."""
    rng = random.Random(7)
    words = lambda n: [f"z{rng.randint(0, 99999)}" for _ in range(n)]
    texts = []
    for k in range(30):
        left, body, right = words(8), words(40), words(8)
        if k % 3 == 0:
            left, right = words(12), words(12)  # of these, the partners do repeat 52 words
        texts += [words(30) + left + body + right + words(30), words(30) + left + body + words(30), words(30) + body + right + words(30)]
    texts = [" ".join(t) for t in texts]
    want = spans(texts)
    assert run(spark, list(enumerate(texts))) == want and len(want) == 30


def test_words_of_equal_checksum_are_told_apart(spark):
    """Two texts of 70 words that differ in one word, of equal crc32."""
    assert zlib.crc32(b"plumless") == zlib.crc32(b"buckeroo")
    base = [f"q{i}" for i in range(70)]
    texts = [" ".join(base[:35] + [w] + base[36:]) for w in ("plumless", "buckeroo")]
    assert run(spark, list(enumerate(texts))) == {} == spans(texts)
    longer = [" ".join(base[:15] + [w] + base[16:]) for w in ("plumless", "buckeroo")]
    assert run(spark, list(enumerate(longer))) == {0: [(16, 70)], 1: [(16, 70)]} == spans(longer)


def test_extension_is_against_one_partner():
    own = [f"w{i}" for i in range(75)]
    assert extended(own, 25, own, 25) == (0, 25)
    assert extended(own, 25, ["x"] * 5 + own[20:], 10) == (20, 25)
    assert extended(own, 25, own[:60] + ["x"] * 9, 25) == (0, 10)
    low, high = extended(own, 25, ["x"] * 5 + own[20:60], 10)
    assert high < low


def test_windows_shared_by_many_contexts(spark):
    """Passages in surroundings that differ, over more partitions than rows of
    a window: its neighbours lie in different partitions."""
    rng = random.Random(3)
    words = lambda n: [f"y{rng.randint(0, 99999)}" for _ in range(n)]
    common, other = words(54), words(52)
    texts = [" ".join(words(rng.randint(3, 30)) + (common if k % 4 else other) + words(rng.randint(3, 30))) for k in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, list(enumerate(texts))) == spans(texts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_very_long_text(spark):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(80)]
    text = [f"l{rng.randint(0, 10**7)}" for _ in range(60_000)]
    text[1000:1080] = text[40_000:40_080] = passage
    texts = [" ".join(text), " ".join(["other"] + passage), "z" * 1_000_000]
    assert run(spark, list(enumerate(texts))) == spans(texts)
