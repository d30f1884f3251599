import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starlens.llm import negatives, tiles
from starlens.llm.negatives import OP12_SQL, hard_negatives, op12_negatives, products, strassen
from starlens.llm.tiles import LIMIT, entry, exact, merged

NAN, INF = float("nan"), float("inf")
COLS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def shown(s):
    return max(-LIMIT, min(LIMIT, s))


def naive(rows, every=100, k=5, m=10):
    """Rows (id, vector, label); repeated rows are rows of their own."""
    ok = [(i, [math.floor(256 * x) if abs(x) < 2**53 else int(x) * 256 for x in v], str(lab)) for i, v, lab in rows
          if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (a, va, la) in enumerate(ok):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(va, v)), i, lab == la) for j, (i, v, lab) in enumerate(ok) if j != n and len(v) == len(va)]
        for s, p, _ in sorted(x for x in scored if x[2])[:k]:
            hard = sorted(x for x in scored if not x[2] and 30 * -s <= 100 * -x[0] <= 90 * -s)[:m]
            out += [(a, p, r + 1, i, shown(-s), shown(-t)) for r, (t, i, _) in enumerate(hard)]
    return sorted(out)


def run(spark, rows, every=100, kind="array<double>"):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], f"vec_id long, embedding {kind}, label int, rank int, part string, seq int")
    return sorted(tuple(r[c] for c in COLS) for r in hard_negatives(df, F.col("vec_id") % every == 0).collect())


@pytest.mark.parametrize("m,k,n", [(1, 1, 1), (3, 5, 7), (33, 64, 100), (65, 130, 71), (128, 64, 128)])
def test_strassen_is_exact(m, k, n):
    rng = np.random.default_rng(m)
    a, b = rng.integers(-300, 300, (m, k)), rng.integers(-300, 300, (k, n))
    assert (strassen(a, b, leaf=2) == a @ b).all()
    assert (strassen(a.astype(object), b.astype(object), leaf=4) == a @ b).all()


def test_strassen_wraps_but_results_within_64_bits_stay_exact():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(2**29), 2**29, (9, 8)), rng.integers(-(2**29), 2**29, (8, 9))
    want = a.astype(object) @ b.astype(object)
    assert (strassen(a, b, leaf=1) == want).all()
    big = rng.integers(2**40, 2**41, (5, 6))
    assert (products(big, big) == big.astype(object) @ big.T.astype(object)).all()  # beyond 64 bits


def test_entries_keep_the_order_of_scores():
    scores = [0, 1, -1, LIMIT - 1, LIMIT, LIMIT + 1, -LIMIT, -LIMIT - 1, 10**40, 10**40 + 1, -(10**40), 10**300, -(10**300), 2**64, 255, 256]
    entries = sorted(((entry(s, 1), s) for s in scores), key=lambda e: (e[0][0], e[0][1] or b""))
    assert [s for _, s in entries] == sorted(scores, reverse=True)
    assert all(exact(*e[:2]) == s for e, s in entries)
    assert merged([(1, None, 2), (3, None, 1)], [(1, None, 1), (2, None, 9)], 3) == [(1, None, 1), (1, None, 2), (2, None, 9)]


def test_equals_naive_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(tiles, "SHARD_CELLS", 90)
    monkeypatch.setattr(tiles, "BLOCK_CELLS", 30)
    monkeypatch.setattr(tiles, "SHARDS", 2)
    rng = random.Random(2)
    rows = [(i, [rng.randint(-40, 200) / 256 for _ in range(3)], rng.choice([0, 0, 0, 1, 2])) for i in range(400)]
    want = naive(rows, 20)
    assert len(want) > 300 and run(spark, rows, 20) == want


def test_hot_label_copies_and_repeated_ids(spark):
    rng = random.Random(4)
    rows = [(i, [rng.random(), rng.random()], rng.choice([1, 1, 1, 2])) for i in range(60)]
    rows += [(100, [.5, .5], 1)] * 4 + [(7, [.4, .4], 2)] * 5 + [(7, [.3, .4], 1)]  # rows are ranked, not ids
    want = naive(rows)
    assert want and run(spark, rows) == want


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 1.5], 1), (2, [.5, .5], 2), (3, None, 2), (4, [1.0, None], 2), (5, [NAN, 1.0], 2), (6, [INF, 1.0], 2),
            (8, [.5, .5], None), (9, [], 2), (None, [.5, .5], 2), (10, [.5], 2), (100, [1.0], 2), (11, [.9], 2), (12, [.5], 3),
            (200, [0.0, 0.0], 1), (300, [-1.0, 0.0], 5), (13, [1.0, 0.0], 5), (14, [-.5, 0.0], 6), (400, [1.0, 1.0], 9)]
    assert run(spark, rows) == naive(rows)
    assert run(spark, [(0, [1.0], 1)]) == [] and run(spark, []) == []


def test_huge_components_are_exact(spark):
    rows = [(0, [2.0**60, 1.0], 1), (1, [2.0**60, 1.0], 1), (2, [2.0**59, 1.5], 2), (3, [2.0**59, 1.25], 2), (4, [1e300, 1.0], 1),
            (5, [5e299, 1.0], 2), (6, [6e299, 1.0], 3), (7, [2.0**59, 1.5], 2)]
    want = naive(rows)
    assert len(want) >= 5 and run(spark, rows) == want


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_equals_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{path}/embeddings.parquet'")
    want = sorted(con.execute(OP12_SQL).df()[COLS].itertuples(index=False, name=None))
    assert want and sorted(tuple(r[c] for c in COLS) for r in op12_negatives(spark, path).collect()) == want
