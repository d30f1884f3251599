import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from starlens.llm import masks
from starlens.llm.masks import OP13_SQL, op13_masks, ranked_search, terms

COLS = ["item_id", "rank", "doc_id", "score"]
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def cut(text):
    return PATTERN.findall((text or "").translate(LOWER))


def naive(docs, items, k=20):
    counted = [(i, Counter(cut(t)), len(cut(t))) for i, t in docs]
    n_docs, total = sum(n > 0 for *_, n in counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counted:
            m = 75 + (25 * n * n_docs) // total if total else 0
            s = sum(w[t] * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in cut(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, item_id int, term string")
    q = spark.createDataFrame([(*r, 2, "y") for r in items], "item_id long, text string, doc_id int, key string")
    return sorted((tuple(r[c] for c in COLS) for r in ranked_search(d, q, **kw).collect()), key=str)


def corpus(n, seed, words=60):
    rng = random.Random(seed)
    word = lambda: f"w{int(words * rng.random() ** 3)}"
    text = lambda n: " ".join(word() for _ in range(n))
    return [(i, text(rng.choice([0, 1, 3, 8, 30, 200]))) for i in range(n)], [(i, text(rng.randint(1, 25))) for i in range(30)]


def test_terms_follow_the_pattern():
    rng = random.Random(1)
    for _ in range(2000):
        t = "".join(chr(rng.choice([*range(0, 130), 0xC4, 0xDF, 0x130, 0x2003, 0x3000, 0x4E2D, 0x1F600])) for _ in range(30))
        assert [x.decode() for x in terms(t)] == cut(t)


def test_equals_naive(spark):
    docs, items = corpus(900, 2)
    assert run(spark, docs, items) == naive(docs, items)


@pytest.mark.parametrize("hinted", [500_000, 5])
def test_small_blocks_many_buckets_and_a_large_vocabulary(spark, monkeypatch, hinted):
    for name, value in (("DOCS_BITS", 4), ("POSTINGS", 60), ("ITEM_TERMS", 40), ("BLOCKS", 2), ("HELD", 3), ("HINTED_TERMS", hinted)):
        monkeypatch.setattr(masks, name, value)
    docs, items = corpus(400, 3)
    assert run(spark, docs, items) == naive(docs, items)
    assert run(spark, docs, items, k=3) == naive(docs, items, 3)


def test_copies_ties_and_long_texts(spark):
    """Ties at the last place go by id; an item of over 64 distinct terms has masks of several words."""
    docs, items = corpus(150, 4, words=300)
    docs += [(1000 - i, "same words again and again") for i in range(60)] + [(7, "same words")] * 3
    docs += [(2000, " ".join(f"w{i % 290}" for i in range(30_000))), (2001, "x" * 100_000)]
    items += [(50, "same words"), (51, " ".join(f"w{i}" for i in range(250))), (52, " ".join(["w1"] * 70 + ["again"] * 9)), (53, "x" * 100_000)]
    assert run(spark, docs, items) == naive(docs, items)


def test_odd_rows(spark):
    docs = [(1, "One two"), (1, "One two"), (None, "one TWO"), (2, None), (3, ""), (4, " .,! "), (5, "Ünïcode ünïcode İ"), (6, "one"), (6, "two"), (-3, "one two")]
    items = [(1, "ONE"), (1, "ONE"), (2, None), (3, ""), (4, "nothing here"), (5, "Ünïcode"), (None, "two one one"), (7, "zzz")]
    assert run(spark, docs, items) == naive(docs, items)
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, [(1, None)], items) == []


def test_search_leaves_low_groups_but_keeps_ties():
    rng = np.random.default_rng(3)
    row = {"ids": np.arange(500, dtype="<i8").tobytes(), "nameless": np.zeros(500, "i1").tobytes(), "sizes": rng.integers(1, 50, 500).astype("<i8").tobytes()}
    lists = [np.sort(rng.choice(500, rng.integers(1, 400), replace=False)) for _ in range(9)]
    row |= {"tids": np.arange(1, 10, dtype="<i8").tobytes(), "ends": np.cumsum([len(x) for x in lists]).astype("<i4").tobytes(),
            "at": np.concatenate(lists).astype("<i4").tobytes(), "tf": rng.integers(1, 5, sum(map(len, lists))).astype("<i4").tobytes()}
    block = masks._Block(row, 500, 12_000)
    query = [(t, int(w)) for t, w in zip(range(1, 12), rng.integers(1, 9000, 11))]
    full = np.zeros(500, np.int64)
    for t, w in query[:9]:
        a, b = block.spans[t]
        full[block.at[a:b]] += w * block.impact[a:b]
    for k in (1, 5, 20):
        last = np.sort(full)[-k]
        got = dict(zip(*(x.tolist() for x in masks.search(block, query, k, 1))))
        assert got == {i: int(full[i]) for i in np.flatnonzero(full >= last)}
        higher = dict(zip(*(x.tolist() for x in masks.search(block, query, k, int(last) + 1))))
        assert higher == {i: s for i, s in got.items() if s > last}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.001"])
def test_equals_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{path}/{t}.parquet'")
    want = sorted(con.execute(OP13_SQL).df()[COLS].itertuples(index=False, name=None))
    assert len(want) > 500 and sorted(tuple(r[c] for c in COLS) for r in op13_masks(spark, path).collect()) == want
