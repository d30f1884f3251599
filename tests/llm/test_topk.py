import math
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from starlens.llm import tiles, topk
from starlens.llm.tiles import LIMIT
from starlens.llm.topk import OP10_SQL, best, op10_topk, product, top_k

SF = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")


def naive(rows, k=20):
    """Rows (id, vector); a row that repeats is a row of its own."""
    ok = [(i, [math.floor(64 * x) if abs(x) < 2**53 else int(x) * 64 for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, w) in enumerate(ok):
        if q % 20 == 0:
            hits = sorted((-sum(a * b for a, b in zip(w, v)), i) for m, (i, v) in enumerate(ok) if m != n and len(v) == len(w))
            out += [(q, r + 1, i, max(-LIMIT, min(LIMIT, -s))) for r, (s, i) in enumerate(hits[:k])]
    return sorted(out)


def run(spark, rows, kind="array<float>"):
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], f"vec_id long, embedding {kind}, rank int, shard string")
    return sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 20 == 0).collect())


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    cols = ["query_id", "rank", "vec_id", "score"]
    want = sorted(con.execute(OP10_SQL).df()[cols].itertuples(index=False, name=None))
    assert sorted(tuple(r[c] for c in cols) for r in op10_topk(spark, SF).collect()) == want


def test_many_tiles_and_ties(spark, monkeypatch):
    monkeypatch.setattr(tiles, "SHARD_CELLS", 64)
    monkeypatch.setattr(tiles, "BLOCK_CELLS", 8)
    monkeypatch.setattr(tiles, "SHARDS", 3)
    monkeypatch.setattr(tiles, "HELD", 5)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    rng = random.Random(1)
    rows = [(i, [rng.randint(-2, 2) / 64 for _ in range(2)]) for i in range(500)]
    assert run(spark, rows) == naive(rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [NAN, 1.0]), (4, [INF, 1.0]), (5, [0.0, 0.0]),
            (6, []), (40, []), (7, [3.0]), (60, [4.0]), (80, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (-20, [-0.01, 0.5])]
    assert run(spark, rows) == naive(rows)
    again = rows + [(20, [0.0, 1.0]), (5, [0.0, 0.0]), (20, [1.0, 2.0])]  # rows are ranked, not ids
    assert run(spark, again) == naive(again)
    four = [(20, [1.0]), (1, [1.0]), (1, [1.0]), (2, [1.0])]
    assert run(spark, four) == [(20, 1, 1, 4096), (20, 2, 1, 4096), (20, 3, 2, 4096)]
    assert run(spark, []) == []


def test_repeated_ids_equal_sql(spark):
    rows = [(0, [1.0, 2.0], 0), (0, [1.0, 2.0], 0), (0, [2.0, 1.0], 0), (20, [1.0, 2.0], 0), (1, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, [0.5, 3.0], 0)]
    con = duckdb.connect()
    con.execute("create table embeddings (vec_id bigint, embedding float[], label int)")
    con.executemany("insert into embeddings values (?, ?, ?)", rows)
    want = sorted(con.execute(OP10_SQL).df()[["query_id", "rank", "vec_id", "score"]].itertuples(index=False, name=None))
    assert len(want) == 24 and run(spark, [r[:2] for r in rows]) == want == naive([r[:2] for r in rows])


def test_many_copies_of_one_row(spark, monkeypatch):
    """A third of the rows are one row: its matrices are no larger than others."""
    monkeypatch.setattr(tiles, "SHARD_CELLS", 64)
    rows = [(i, [i / 640, 1.0]) for i in range(200)] + [(7, [0.25, 1.0])] * 100
    assert run(spark, rows) == naive(rows)


def test_huge_components_are_exact(spark):
    rows = [(0, [2.0**23, 1.0]), (1, [2.0**23, 1.0]), (2, [2.0**23, 0.5]), (3, [1e300, 1.0]), (4, [1.5e300, 1.0]), (5, [1e200, -1.0]),
            (20, [-1e300, 2.0]), (40, [2.0**61, 3.0]), (6, [2.0**61, 5.0]), (7, [2.0**61, 4.0])]
    want = naive(rows)
    assert run(spark, rows, "array<double>") == want
    assert [r[2] for r in want if r[0] == 40][:5] == [4, 3, 5, 6, 7]  # all beyond 64 bits, in their true order


def test_best_and_product():
    s = np.array([5, 7, 7, 1, 7])
    assert best(s, np.arange(5), 2).tolist() == [1, 2] and best(s, np.arange(5), 9).tolist() == [1, 2, 4, 0, 3]
    a = np.array([[2.0**30, 3.0]])
    assert product(a, a)[0, 0] == 2**60 + 9
