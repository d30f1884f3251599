import hashlib
import random

import duckdb

from starlens.llm import linechunks
from starlens.llm.linechunks import BASE, OP8_SQL, dedup_line_chunks, op8_line_chunks

SF = "/root/testdata/sf0.01"


def chunks(text):
    lines = text.split("\n")
    v = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    r = [x + BASE * (v[i - 1] if i else 0) for i, x in enumerate(v)]
    out, held = [], []
    for i, line in enumerate(lines):
        held.append(line)
        if i == len(lines) - 1 or 0 < i < len(lines) - 2 and r[i] < r[i - 1] and r[i] <= r[i + 1]:
            out.append(held)
            held = []
    return out


def naive(docs):
    """docs in the order of first occurrence."""
    seen, out = set(), []
    for text in docs:
        left, gone = [], 0
        for c in chunks(text):
            if len(c) > 1 and tuple(c) in seen:
                gone += len(c)
            else:
                left += c
                seen.add(tuple(c))
        out.append(("\n".join(left), len(text.split("\n")), gone))
    return out


def texts(n, seed):
    rng = random.Random(seed)
    passage = [f"shared line {i}" for i in range(12)]
    out = []
    for _ in range(n):
        lines = [f"own {rng.random()}" for _ in range(rng.randint(0, 5))]
        at = rng.randint(0, len(lines))
        out.append("\n".join(lines[:at] + passage[: rng.randint(0, 12)] + lines[at:] + [""] * rng.randint(0, 3)))
    return out + ["", "\n", "same\n" * 9, "same\n" * 9]


def run(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, h int, found string, n_lines int")
    return sorted(((r.row.doc_id, r.text, r.n_lines, r.n_removed) for r in dedup_line_chunks(docs).collect()), key=str)


def test_equals_naive(spark):
    rows = list(enumerate(texts(120, 1)))
    assert run(spark, rows) == sorted([(i, *x) for (i, _), x in zip(rows, naive([t for _, t in rows]))], key=str)


def test_hash_clashes_are_decided_by_bytes(spark, monkeypatch):
    """With a hash of two values nearly all chunks clash, and results stay the same."""
    rows = list(enumerate(texts(40, 2)))
    real = linechunks.F.xxhash64
    monkeypatch.setattr(linechunks.F, "xxhash64", lambda *c: real(*c) % 2 if str(c[0]).find("text") >= 0 else real(*c))
    assert run(spark, rows) == sorted([(i, *x) for (i, _), x in zip(rows, naive([t for _, t in rows]))], key=str)


def test_odd_rows(spark):
    p = "\n".join(f"line {i}" for i in range(30))
    got = run(spark, [(None, p), (1, p), (2, None), (3, ""), (4, "one"), (5, p + "\nmore"), (6, "q\nr\ns\nt"), (6, "q\nr\ns\nt")])
    left = {r[0]: r for r in got}
    assert left[None] == (None, p, 30, 0)  # nulls come first
    assert left[1][3] > 20 and left[2] == (2, None, 0, 0) and left[3] == (3, "", 1, 0) and left[4] == (4, "one", 1, 0)
    assert left[5][1].endswith("more") and left[5][3] > 20
    assert [r for r in got if r[0] == 6] == [(6, "q\nr\ns\nt", 4, 0)] * 2  # one document, given twice
    assert run(spark, [])  == []


def test_documents_table(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    cols = ["doc_id", "n_lines", "n_removed", "text"]
    want = sorted(con.execute(OP8_SQL).df()[cols].itertuples(index=False, name=None))
    assert sorted(tuple(r[c] for c in cols) for r in op8_line_chunks(spark, SF).collect()) == want
    assert sum(r[2] for r in want) > 0


def test_exact_copies_and_repeated_runs_go(spark):
    """On sf0.1: of later copies of documents of several lines nothing stays,
    and of runs of 12 lines or more that stood before at most the ends do."""
    rows = sorted((r.row.doc_id, r.row.text or "", r.text or "") for r in dedup_line_chunks(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).collect())
    seen, copies, stayed = set(), 0, 0
    for _, text, left in rows:
        if text in seen and "\n" in text:
            copies += 1
            stayed += left != ""
        seen.add(text)
    assert copies > 500 and stayed == 0
    pairs, in_runs, left_over = set(), 0, 0
    for _, text, left in rows:
        lines = text.split("\n")
        again = [p in pairs for p in zip(lines, lines[1:])]
        kept, at = left.split("\n") if left else [], 0
        for i in range(len(again) + 1):
            if i < len(again) and again[i]:
                at += 1
            else:
                if at >= 11:
                    run_ = lines[i - at : i + 1]
                    in_runs += len(run_)
                    left_over += sum(x in set(kept) for x in run_)
                at = 0
        pairs.update(zip(lines, lines[1:]))
    assert in_runs > 1000 and left_over < 0.12 * in_runs


def test_passages_in_other_surroundings(spark):
    rng = random.Random(9)
    passages = [[f"p{k} {i} {rng.random()}" for i in range(n)] for k, n in enumerate([6] * 100 + [20] * 100)]
    own = lambda k: [f"own {rng.random()}" for _ in range(k)]
    rows = [(2 * k + j, "\n".join(own(rng.randint(1, 4)) + p + own(rng.randint(1, 4)))) for k, p in enumerate(passages) for j in (0, 1)]
    got = run(spark, rows)
    assert got == sorted([(i, *x) for (i, _), x in zip(rows, naive([t for _, t in rows]))], key=str)
    gone = {r[0]: r[3] for r in got}
    for k, p in enumerate(passages):  # between the first and the last inner cut all goes
        cuts, at = [], 0
        for c in chunks("\n".join(p)):
            at += len(c)
            cuts.append(at)
        inner = [c for c in cuts if 3 <= c <= len(p) - 2]  # cuts that hang on the passage's own lines only
        assert gone[2 * k + 1] >= (inner[-1] - inner[0] if inner else 0)
    assert sum(gone[2 * k + 1] for k in range(100, 200)) > 0.6 * 2000


def test_a_very_long_text_and_a_chunk_in_every_document(spark):
    long = "\n".join(f"line {i}" for i in range(60_000))
    common = "\n".join(f"common {i}" for i in range(9))
    rows = [(0, long), (1, "first\n" + long), *((i, f"own {i}\nown too {i}\n{common}\nand {i}\nend {i}") for i in range(2, 200)), (300, "x" * 2_000_000), (301, "x" * 2_000_000)]
    got = run(spark, rows)
    assert got == sorted([(i, *x) for (i, _), x in zip(rows, naive([t for _, t in rows]))], key=str)
    assert {r[0]: r[3] for r in got}[1] > 59_990
