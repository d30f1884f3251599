import itertools
import zlib

import numpy as np

from starlens.llm.common import table
from starlens.llm.quality import BASE, WIDTH, LineField, design, fit_quality, forward_backward, held_out, line_features, op4_quality, score_quality


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 5, 0, 2])
    emit, turn = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    good, pairs, log_z = forward_backward(emit, lengths, turn)
    at, want_good, want_pairs, want_z = 0, [], np.zeros((2, 2)), 0.0
    for n in lengths:
        e, total, marg, pr = emit[at : at + n], 0.0, np.zeros(n), np.zeros((2, 2))
        at += n
        if not n:
            continue
        for path in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(x * y for x, y in zip(e, path)) + sum(turn[a, b] for a, b in itertools.pairwise(path)))
            total += w
            marg += w * np.array(path)
            for a, b in itertools.pairwise(path):
                pr[a, b] += w
        want_good += (marg / total).tolist()
        want_pairs += pr / total
        want_z += np.log(total)
    assert np.allclose(good, want_good) and np.allclose(pairs, want_pairs) and np.isclose(log_z, want_z)


def test_design_looks_at_neighbours_within_a_document_only():
    base = line_features(["aaa", "BBB!!", "c c c", "d"])
    x = design(base, np.array([2, 2]), np.zeros(BASE), np.ones(BASE))
    assert x.shape == (4, WIDTH)
    before, after = x[:, 1 + 3 * BASE : 1 + 4 * BASE], x[:, 1 + 4 * BASE :]
    assert not before[0].any() and not before[2].any() and not after[1].any() and not after[3].any()
    assert (before[1] == x[0, 1 : 1 + BASE]).all() and (after[2] == x[3, 1 : 1 + BASE]).all()


def test_held_out_rows_and_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op4_quality(spark, sf).toPandas().set_index("doc_id")
    assert len(got) == table(spark, sf, "documents").count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    labels = table(spark, sf, "labels").toPandas().set_index("doc_id")
    held = got[got.held_out].join(labels, how="inner")
    assert len(held) > 500 and (held.predicted == held.quality).mean() > 0.97
    good = held[held.quality == 1]
    assert (good.predicted == 1).mean() > 0.98


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = spark.createDataFrame([(i, "good line here\nand more of it" if i % 2 else "BAD!! BAD!! BAD!!") for i in range(60)], "doc_id long, text string")
    rows = [(i, i % 2) for i in range(60)]
    wrong = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in rows]
    a = fit_quality(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
    b = fit_quality(docs, spark.createDataFrame(wrong, "doc_id long, quality int"))
    assert (a.weights == b.weights).all() and (a.turn == b.turn).all()


def test_odd_rows(spark):
    none = LineField.fit(np.zeros((0, BASE)), np.zeros(0, int), np.zeros(0))
    assert none.scores(["x", None, ""]) == [0.5] * 3
    docs = spark.createDataFrame([(i, "plain text of words\nmore words" if i % 2 else "A!! A!! | A!!", i) for i in range(40)]
                                 + [(None, None, 1), (None, "", 2), (7, "w " * 50_000, 3), (7, "\n" * 20_000, 3)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (1, None), (3, 0), (3, 1), (3, 1), (900, 0)], "doc_id long, quality int")
    got = score_quality(docs, fit_quality(docs, labels), ["doc_id", "score"]).collect()
    assert len(got) == 44 and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.kept.doc_id is None}
    assert len(empty) == 1  # null and empty texts alike
    assert score_quality(docs.limit(0), none, ["doc_id"]).count() == 0
    assert [r[0] for r in docs.limit(0).select(held_out(docs.doc_id)).collect()] == []


def test_fit_is_bounded_in_rows_and_lines(spark, monkeypatch):
    """Equal rows are learned once; of very long texts only max_lines lines are."""
    learned = []
    real = LineField.fit
    monkeypatch.setattr(LineField, "fit", lambda x, lengths, *a, **b: learned.append(list(lengths)) or real(x, lengths, *a, **b))
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 5][:4]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    texts = {i: "\n".join(f"line {k} of {i}" for k in range(150 if i == ids[0] else 3)) for i in ids}
    docs = [(i, texts[i]) for i in ids]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    once, often = fit_quality(frame(docs), labels), fit_quality(frame(docs + [docs[1]] * 500), labels)
    assert sorted(learned[0]) == sorted(learned[1]) == [3, 3, 3, 150]
    assert (once.weights == often.weights).all()
    long = [(ids[0], "\n".join(f"line {k} of {k % 7}" for k in range(20_000)))] + docs[1:]
    fit_quality(frame(long), labels, max_lines=1000)
    assert 1000 - 64 <= sum(learned[2]) <= 1000
    fit_quality(frame(long), labels, max_documents=4)
    assert sum(learned[3]) <= 16 * 64
