import random
import re

import pytest
import xxhash

from starlens.llm.common import components, table
from starlens.llm.simhash import ball, fingerprint, near_duplicates, op3_simhash


def naive(text, words=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, bits=2):
    """Smallest index reachable, by comparing all pairs."""
    comp = list(range(len(fps)))
    find = lambda i: i if comp[i] == i else find(comp[i])
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                comp[b] = a
    return [find(i) for i in range(len(fps))]


def test_fingerprint_equals_naive():
    rng = random.Random(1)
    texts = [None, "", " \t\x0b", "One", "one TWO", "a b c", "É é ß \xa0x", "x " * 70000]
    texts += [" ".join(rng.choice(["a", "Bb", "cÇ", "d\n"]) for _ in range(rng.randint(1, 40))) for _ in range(200)]
    for t in texts:
        assert fingerprint(t) & (1 << 64) - 1 == naive(t)


def test_documents_table(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op3_simhash(spark, "/root/testdata/sf0.001").collect()}
    docs = sorted((d.doc_id, naive(d.text)) for d in table(spark, "/root/testdata/sf0.001", "documents").collect())
    comp = groups([f for _, f in docs])
    assert got == {d: (f"{f:016x}", docs[c][0]) for (d, f), c in zip(docs, comp)}


def test_links_between_fingerprints(spark):
    """Near texts made by changing one word of many, many copies, nulls and repeated rows."""
    rng = random.Random(3)
    base = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(300)) for _ in range(6)]
    texts = []
    for t in base:
        w = t.split()
        for _ in range(6):
            v = list(w)
            v[rng.randrange(len(v))] = "changed"
            texts.append(" ".join(v))
        texts += [t] * 4
    texts += [None, "", "solo"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0])]
    docs = spark.createDataFrame([(*r, 9, "x") for r in rows], "doc_id long, text string, fp int, component_id string")
    got = {r.id: r.component_id for r in near_duplicates(docs).collect()}
    assert near_duplicates(docs).count() == len(rows)
    assert got == dict(enumerate(groups([naive(t) for t in texts])))


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c"), (7, "a b c"), (None, "other words here")], "doc_id long, text string")
    got = sorted(((r.id, r.component_id) for r in near_duplicates(docs).collect()), key=str)
    assert got == [(7, 7), (None, 7), (None, None)]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_ball_and_bits():
    assert len(ball(1)) == 65 and len(ball(2)) == 2081
    with pytest.raises(ValueError):
        from starlens.llm.simhash import links

        links(None, 3)


def test_components_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)] + [(None, 3), (5, 5)]
    edges = spark.createDataFrame(chain + star, "a long, b long")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
