import duckdb
import numpy as np
import pytest

from starlens.llm import crosspolytope as cp
from starlens.llm.common import table
from starlens.llm.crosspolytope import OP6_SQL, axes, hadamard, near_vectors, op6_near_vectors

NAN = float("nan")


def brute(ids, labels, x, threshold=0.93):
    n = len(ids)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (u @ u.T >= threshold) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(link, False)
    root = np.array(ids)
    while True:
        new = np.minimum(root, np.where(link, root[None, :], root.max()).min(1))
        if (new == root).all():
            break
        root = new
    return {i: (int(link[k].sum()), int(root[k]), bool(root[k] == i)) for k, i in zip(range(n), ids)}


def clustered(n, seed=0, dim=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    x = centres[rng.integers(0, 8, n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.15, 0.3, 2.0], size=(n, 1))
    return x, rng.integers(0, 3, n)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "vec_id long, embedding array<double>, label int, rep int, bucket string")
    return [tuple(r) for r in near_vectors(df, **kw).collect()]


def test_hadamard_keeps_lengths_and_axes_are_stable():
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)
    assert (axes(x, 2, 2) == axes(3 * x, 2, 2)).all() and axes(x[:, :1], 2, 1).shape == (5, 2, 1, 1)


@pytest.mark.parametrize("hashes,block", [(1, 2048), (2, 2048), (1, 16)])
def test_equals_brute_force(spark, monkeypatch, hashes, block):
    """Few axes: every pair meets; small blocks: buckets are compared tile by tile."""
    monkeypatch.setattr(cp.link_counts, "__defaults__", (block,))
    x, labels = clustered(300)
    x[250:270] = x[0]  # copies
    labels[250:260] = labels[0]
    want = brute(list(range(300)), labels, x)
    got = {r[0]: r[1:] for r in run(spark, [(i, x[i].tolist(), int(labels[i])) for i in range(300)], hashes=hashes)}
    assert len(got) == 300
    missed = sum(max(0, want[i][0] - got[i][0]) for i in got)
    assert all(got[i][0] <= want[i][0] for i in got)
    assert missed <= 0.002 * sum(w[0] for w in want.values())
    if not missed:
        assert got == want


@pytest.mark.parametrize("dim", [1, 3, 24, 200])
def test_sketches_bound_the_cosine(dim):
    """Every pair's cosine lies between its bounds, and a sketch comes back from its bytes as it went."""
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(200, dim)) * rng.choice([0.01, 1.0, 30.0], size=(200, dim))
    x = cp.unit(np.concatenate([x, x + 0.2 * rng.normal(size=x.shape)]))
    codes, ids = axes(x, 4, 1), np.arange(400)
    one = cp.opened(ids, ids, cp.bodies(x, codes).tobytes(), dim, 1, 4)
    numbers, step, error = cp.sketch(x)
    assert (one["numbers"] == numbers).all() and (one["step"] == step).all() and (one["error"] == error).all() and (one["codes"] == codes).all()
    estimate, margin = cp.bounds(one, one)
    assert (np.abs(estimate - x @ x.T) <= margin).all()
    assert (estimate == estimate.T).all() and (margin == margin.T).all()


def test_bucket_keys_come_back():
    codes = np.array([[0, 127], [126, 3]])
    for t in (0, 5):
        for key, code in zip(cp.bucket_keys(t, codes, 64), codes):
            no, digits = cp._digits(int(key), 64, 2)
            assert no == t and (digits == code).all()


@pytest.mark.parametrize("block", [2048, 16])
def test_a_group_whose_cosines_lie_at_the_threshold(spark, monkeypatch, block):
    """Nearly every pair lies between the bounds: settled by the vectors, within and across blocks."""
    monkeypatch.setattr(cp.link_counts, "__defaults__", (block,))
    rng = np.random.default_rng(9)
    x = rng.normal(size=8)[None, :] + rng.normal(size=(90, 8)) * 0.25
    want = brute(list(range(90)), [0] * 90, x)
    got = {r[0]: r[1:] for r in run(spark, [(i, x[i].tolist(), 0) for i in range(90)])}
    assert 0 < sum(w[0] for w in want.values()) < 90 * 89
    assert sum(g[0] for g in got.values()) >= 0.998 * sum(w[0] for w in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)


def test_recall_on_the_table_with_near_copies(spark):
    """The table's vectors, and for a tenth of them copies turned to cosines around the threshold."""
    v = table(spark, "/root/testdata/sf0.1", "embeddings").toPandas().sort_values("vec_id")
    x, labels, rng = np.array([np.asarray(e, float) for e in v.embedding]), v.label.to_numpy(), np.random.default_rng(4)
    near = np.repeat(np.arange(0, len(x), 10), 4)
    turned = x[near] + rng.normal(size=(len(near), x.shape[1])) * rng.choice([0.02, 0.03, 0.04, 0.045], size=(len(near), 1))
    x, labels = np.concatenate([x, turned]), np.concatenate([labels, labels[near]])
    want = brute(list(range(len(x))), labels, x)
    got = {r[0]: r[1:] for r in run(spark, [(i, x[i].tolist(), int(labels[i])) for i in range(len(x))])}
    links = sum(w[0] for w in want.values())
    assert links > 500 and sum(g[0] for g in got.values()) >= 0.998 * links
    assert sum(got[i] == want[i] for i in want) >= 0.998 * len(want)


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    cols = ["vec_id", "n_links", "component_id", "kept"]
    want = sorted(con.execute(OP6_SQL).df()[cols].itertuples(index=False, name=None))
    assert sorted(tuple(r[c] for c in cols) for r in op6_near_vectors(spark, sf).collect()) == want


def test_odd_rows(spark):
    rows = [(5, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (9, [2.0, 0.1], 1), (4, [1.0, 0.0], 2), (6, [1.0, 0.0], None),
            (7, None, 1), (8, [0.0, 0.0], 1), (10, [NAN, 1.0], 1), (11, [1.0, None], 1), (None, [1.0, 0.0], 1), (12, [1.0], 1), (13, [], 1),
            (14, [1e200, 0.0], 3), (15, [1e-200, 0.0], 3)]
    got = sorted(run(spark, rows), key=str)
    want = [(5, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (9, 2, 3, False), (14, 1, 14, True), (15, 1, 14, False),
            (None, 0, None, True)] + [(i, 0, i, True) for i in (4, 6, 7, 8, 10, 11, 12, 13)]
    assert got == sorted(want, key=str)
    assert run(spark, []) == []


def test_signed_zeros_and_clashing_hashes(spark, monkeypatch):
    """0.0 equals -0.0; where hashes of classes clash, rows meet their class by label and vector."""
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, -0.0], 1), (2, [1.0, -0.0], 1), (3, [0.0, 1.0], 1), (4, [0.0, 1.0], 2), (5, None, 2)]
    want = [(1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True)]
    assert sorted(run(spark, rows)) == want
    monkeypatch.setattr(cp.F, "xxhash64", lambda *c: cp.F.lit(7).cast("long"))
    assert sorted(run(spark, rows)) == want


def test_an_id_under_two_labels(spark):
    """Its row without a near vector has no link and is its own component; links of its labels do not mix."""
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (1, [0.0, 1.0], 2), (0, [1.0, 0.0], 3), (2, [1.0, 0.01], 3), (1, [-1.0, 0.0], 1)]
    want = [(0, 1, 0, True), (1, 0, 1, True), (1, 0, 1, True), (1, 1, 1, True), (2, 1, 0, False), (2, 1, 1, False)]
    assert sorted(run(spark, rows)) == want
    con = duckdb.connect()
    con.execute("create table embeddings (vec_id bigint, embedding double[], label int)")
    con.executemany("insert into embeddings values (?, ?, ?)", rows)
    assert sorted(con.execute(OP6_SQL).df()[["vec_id", "n_links", "component_id", "kept"]].itertuples(index=False, name=None)) == want


@pytest.mark.parametrize("hashes,dim", [(1, 64), (1, 256), (2, 64)])
def test_recall_in_high_dimension(spark, hashes, dim):
    """Random vectors and copies turned to a cosine just above the threshold, the hardest to find."""
    rng = np.random.default_rng(dim + hashes)
    x = rng.normal(size=(400, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = rng.normal(size=x.shape)
    turn -= (turn * x).sum(1, keepdims=True) * x
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    x = np.concatenate([x, 0.931 * x + np.sqrt(1 - 0.931**2) * turn])
    want = brute(list(range(800)), [0] * 800, x)
    got = {r[0]: r[1:] for r in run(spark, [(i, x[i].tolist(), 0) for i in range(800)], hashes=hashes)}
    links = sum(w[0] for w in want.values())
    assert links == 800 and sum(g[0] for g in got.values()) >= 0.97 * links
    assert all(got[i][0] <= want[i][0] for i in want)
