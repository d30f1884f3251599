import math
from collections import Counter

import duckdb
import pytest

from starlens.llm.mixing import OP1_SQL, bisect_exponent, mix, op1_mixing, plan_mixture

SF = "/root/testdata/sf0.01"


def skewed(spark, n=600):
    """A third in one source, the rest thin; texts of 1 to 9 words."""
    rows = [(i, "w " * (1 + i % 9), "hot" if i % 3 == 0 else f"s{i % 11}") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def exponent(shares, entropy, repeats):
    lo, hi = 0.0, 1.0

    def up(a):
        z = sum(p**a for p in shares)
        h = math.log(z) - a * sum(p**a * math.log(p) for p in shares) / z
        return (max(shares) / min(shares)) ** (1 - a) > repeats or h >= entropy * math.log(len(shares))

    if up(1.0):
        return 1.0
    for _ in range(30):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if up(mid) else (lo, mid)
    return hi


@pytest.mark.parametrize("entropy,repeats", [(0.95, 2.0), (0.9, 100.0), (0.999, 1.5), (0.1, 5.0)])
def test_exponent(spark, entropy, repeats):
    shares = [0.5, 0.3, 0.1, 0.06, 0.04]
    df = spark.createDataFrame([(p,) for p in shares], "p double")
    assert abs(bisect_exponent(df, entropy, repeats, None) - exponent(shares, entropy, repeats)) < 1e-8


def test_every_document_and_the_limits(spark):
    docs = skewed(spark)
    plan = plan_mixture(docs).collect()
    reads = Counter(r.id for r in plan)
    assert set(reads) == set(range(600)) and max(reads.values()) <= 2
    got = Counter()
    for r in plan:
        got[r.source] += r.tokens
    weights = {r.source: r.weight for r in plan}
    total = sum(got.values())
    assert abs(sum(weights.values()) - 1) < 1e-6
    for s, w in weights.items():  # a quota is missed by less than a document
        assert abs(got[s] - w * total) < 20
    assert Counter(r.doc_id for r in mix(docs).collect()) == reads
    for key in {(r.source, r["pass"]) for r in plan}:  # a pass is a permutation of blocks
        blocks = {(r.block, r.place) for r in plan if (r.source, r["pass"]) == key}
        assert len({b for b, _ in blocks}) == len({p for _, p in blocks}) == len(blocks)


def test_budget(spark):
    docs = skewed(spark)
    plan = plan_mixture(docs, budget_tokens=900, max_repeats=50).collect()
    got = Counter()
    for r in plan:
        got[r.source] += r.tokens
    for r in plan:
        assert r.weight * 900 - 10 <= got[r.source] <= r.weight * 900 + 1


def test_odd_rows(spark):
    rows = [(1, "a b", None), (1, "a b", None), (None, "c", "x"), (2, None, "x"), (3, "", "void"), (4, "d e f", "x")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, source string, block int, h string")
    got = Counter(map(str, mix(docs).collect()))
    assert {k: v >= 1 for k, v in got.items()} == {str(r): True for r in docs.collect()}
    assert got[next(k for k in got if "doc_id=1" in k)] % 2 == 0
    assert mix(docs.limit(0)).count() == 0
    assert mix(docs.where("doc_id = 3")).count() == 1


@pytest.mark.parametrize("big", [False, True])
def test_equals_sql(spark, tmp_path, big):
    con = duckdb.connect()
    if big:
        sf = str(tmp_path)
        skewed(spark, 2000).write.parquet(f"{sf}/documents.parquet")
        con.execute(f"create view documents as select * from '{sf}/documents.parquet/*.parquet'")
    else:
        sf = SF
        con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    cols = ["doc_id", "source", "weight", "pass", "block", "place", "tokens"]
    want = sorted(con.execute(OP1_SQL).df()[cols].itertuples(index=False, name=None))
    assert sorted(tuple(r[c] for c in cols) for r in op1_mixing(spark, sf).collect()) == want


def test_the_mixed_corpus_follows_the_permuted_blocks(spark):
    """Read in order, the rows come by pass and by the place of their block."""
    docs = spark.createDataFrame([(i, f"w{i} " * (1 + i % 7), "abc"[i % 10 // 4]) for i in range(300)], "doc_id long, text string, source string")
    plan = {}
    for r in plan_mixture(docs).collect():
        plan.setdefault(r.id, []).append((r["pass"], r.place))
    read, seen = [r.doc_id for r in mix(docs).collect()], Counter()
    keys = []
    for i in read:
        keys.append(sorted(plan[i])[seen[i]])
        seen[i] += 1
    assert len({k[1] for k in keys}) > 5 and keys == sorted(keys)


def test_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "long " * 400_000, "a"), (2, "short text", "a"), (3, "other words", "b")], "doc_id long, text string, source string")
    tokens = {r.id: r.tokens for r in plan_mixture(docs).collect()}
    assert tokens[1] == 400_000 and {r.doc_id for r in mix(docs).collect()} == {1, 2, 3}
