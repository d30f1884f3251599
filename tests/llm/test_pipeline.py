import hashlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpus_pipeline import STAGES, drop_repeated_lines, encode, keep_good, mix_sources, one_of_each_group
from starlens.llm.common import table, written
from starlens.llm.mixing import plan_mixture
from starlens.llm.quality import CUT, fit_quality
from tests.llm.test_linechunks import naive as naive_lines
from tests.llm.test_simhash import groups, naive

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage over the whole table."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in STAGES:
        after = written(stage(spark, docs, SF), "test-pipeline")
        out.append((docs, after))
        docs = after
    return out


def test_columns(stages, spark):
    want = table(spark, SF, "documents").dtypes
    for _, after in stages[:-1]:
        assert after.dtypes == want


def test_quality_stage(stages, spark):
    before, after = stages[0]
    rows = before.collect()
    field = fit_quality(before, table(spark, SF, "labels"))
    good = {r.doc_id for r, s in zip(rows, field.scores(r.text for r in rows)) if s >= CUT}
    assert Counter(map(tuple, after.collect())) == Counter(tuple(r) for r in rows if r.doc_id in good)
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert all((labels[r.doc_id] == 1) == (r.doc_id in good) for r in rows if r.doc_id in labels)


def test_line_stage(stages):
    before, after = stages[1]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    want = {r.doc_id: t for r, (t, _, _) in zip(rows, naive_lines([r.text for r in rows]))}
    got = after.collect()
    assert {r.doc_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_simhash_stage(stages):
    before, after = stages[2]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    comp = groups([naive(r.text) for r in rows])
    assert sorted(map(tuple, after.collect())) == [tuple(rows[i]) for i in sorted(set(comp))]


def test_mixing_stage(stages):
    before, after = stages[3]
    reads = Counter(r.id for r in plan_mixture(before).collect())
    assert Counter(r.doc_id for r in after.collect()) == reads and set(reads) == {r.doc_id for r in before.collect()}
    assert {tuple(r) for r in after.collect()} == {tuple(r) for r in before.collect()}


def test_encoding_stage(stages):
    before, after = stages[4]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in before.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        want[(r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in after.collect()) == want


def test_run_and_odd_rows(spark, tmp_path):
    long = "\n".join(f"line {i} of a long text" for i in range(3000))
    rows = [(1, None, "en", "a", None), (None, "no id here at all", None, None, 3), (2, "", "en", "a", 0), (3, long, "en", "a", 1),
            (3, long, "en", "a", 1), (4, "tie text one two", "fr", "b", 9), (5, "tie text one two", "fr", "b", 9), (None, "no id here at all", None, None, 3)]
    shape = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, h int, n int"
    docs = spark.createDataFrame([(*r, 7, "clash", 8, 9) for r in rows], shape)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    read = table(spark, str(tmp_path), "documents")
    assert keep_good(spark, read, str(tmp_path)).count() == len(rows)  # nothing learned, nothing rejected
    lines = drop_repeated_lines(spark, read, str(tmp_path))
    assert lines.columns == docs.columns and lines.count() == len(rows)
    one = sorted(one_of_each_group(spark, read, str(tmp_path)).collect(), key=str)
    assert sorted((r.doc_id for r in one), key=str) == [1, 3, 4, None] and {r.row for r in one} == {"clash"}
    assert mix_sources(spark, read, str(tmp_path)).select("doc_id").distinct().count() == 6
    assert encode(spark, read, str(tmp_path)).count() == len(rows)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 4
    for _, stage in STAGES:
        assert stage(spark, read.limit(0), str(tmp_path)).count() == 0
