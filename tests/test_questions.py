"""Question -> scope."""

from __future__ import annotations

import json

from conftest import make_star, rows

from starlens.operators.questions import parse_scope, question_scope, strip_fences


def _star(spark):
    return make_star(
        spark,
        dim_regions=[("r1", "West India", None), ("r2", "North India", None), ("r3", "India", None)],
        dim_customer_addresses=[("a1", "Mumbai", "r1"), ("a2", "Delhi", "r2")],
        dim_categories=[("k1", "Electronics")],
        dim_payment_methods=[("m1", "Credit Card"), ("m2", "UPI")],
        fact_shipments=[("s1", "o1", "Delhivery", "dispatched", "t"), ("s2", "o1", "BlueDart", "dispatched", "t")],
        fact_user_clickstream=[("e1", "c1", "k", "mobile", "view", "t")],
        fact_returns=[("x1", "l1", "wrong_item", "return_requested", "t")],
        fact_payments=[("p1", "o1", "m1", 1.0, "failed", None, "t")],
    )


def _scopes(spark, questions):
    q = spark.createDataFrame(list(enumerate(questions)), "qid long, text string")
    out = question_scope(_star(spark), q, id_cols=("qid",))
    return {qid: (json.loads(s), n) for qid, s, n in rows(out.orderBy("qid"), "qid", "scope_json", "scope_keys")}


def test_worked_example(spark):
    got = _scopes(spark, ["Why is Delhivery performing poorly in West India?"])
    # "India" is also a region value; the longer "West India" wins
    assert got[0] == ({"courier_name": "Delhivery", "region": "West India"}, 2)


def test_no_mention_gives_empty_scope(spark):
    got = _scopes(spark, ["Why are payments failing?", "", None])
    assert got[0] == ({}, 0)
    assert got[1] == ({}, 0)
    assert got[2] == ({}, 0)


def test_word_boundaries_and_separators(spark):
    got = _scopes(spark, [
        "How are MOBILE users behaving in mumbai?",
        "returns marked wrong item for electronics paid by credit card",
        "mobiles in Delhi-NCR",
    ])
    assert got[0] == ({"device_type": "mobile", "city": "Mumbai"}, 2)
    assert got[1] == ({"return_reason": "wrong_item", "category": "Electronics", "payment_method": "Credit Card"}, 3)
    # "mobiles" is not the word "mobile"; "Delhi-NCR" contains the word Delhi
    assert got[2] == ({"city": "Delhi"}, 1)


def test_a_kept_vocabulary_reads_no_fact(spark):
    import tempfile

    from starlens.operators.questions import refresh_vocabulary

    star = _star(spark)
    vocab = refresh_vocabulary(star, tempfile.mkdtemp(prefix="starlens-vocab-"))
    q = spark.createDataFrame([(0, "Why is Delhivery late in West India?")], "qid long, text string")
    broken = make_star(spark)  # no values in the star itself
    out = question_scope(broken, q, id_cols=("qid",), vocab=vocab)
    assert json.loads(out.first().scope_json) == {"courier_name": "Delhivery", "region": "West India"}


def test_only_lengths_that_occur_are_made(spark):
    """One very long value adds its own length, not all lengths up to it."""
    star = _star(spark)
    long = " ".join(f"w{i}" for i in range(60))
    vocab = spark.createDataFrame([("city", "Mumbai", "mumbai", 1), ("city", long, long, 60)], "key string, value string, norm string, words int")
    q = spark.createDataFrame([(0, "in mumbai " + "x " * 100), (1, long)], "qid long, text string")
    got = {r.qid: json.loads(r.scope_json) for r in question_scope(star, q, id_cols=("qid",), vocab=vocab).collect()}
    assert got == {0: {"city": "Mumbai"}, 1: {"city": long}}


def test_strip_fences_and_parse(spark):
    df = spark.createDataFrame(
        [('```json\n{"region": "West India"}\n```',), ("not json",), ("[1, 2]",)], "t string"
    )
    out = [r[0] for r in df.select(F_json(parse_scope)).collect()]
    assert out == [{"region": "West India"}, {}, {}]
    assert df.select(strip_fences(df.t)).first()[0] == '{"region": "West India"}'


def F_json(fn):
    from pyspark.sql import functions as F

    return fn(F.col("t"))


def test_investigate_flow(spark):
    from starlens.plans.report import investigate

    star = make_star(
        spark,
        dim_regions=[("r1", "West India", None), ("r2", "North India", None)],
        dim_customer_addresses=[("a1", "Mumbai", "r1"), ("a2", "Delhi", "r2")],
        dim_customers=[("c1", "a1", None), ("c2", "a2", None)],
        fact_order_headers=[("o1", "c1", 10.0, "t"), ("o2", "c1", 10.0, "t"), ("o3", "c2", 10.0, "t")],
        fact_shipments=[("s1", "o1", "Delhivery", "delivery_failed", "t"), ("s2", "o2", "BlueDart", "dispatched", "t"),
                        ("s3", "o3", "Delhivery", "dispatched", "t")],
    )
    out = investigate(star, "Why is Delhivery performing poorly in West India?")
    assert out["scope"] == {"courier_name": "Delhivery", "region": "West India"}
    perf = rows(out["report"]["shipments"]["courier_performance"]["breakdown"])
    assert perf == [("Delhivery", 1, 1, 100.0)]
    kinds = {r["analysis"]: r["kind"] for r in out["findings"].collect()}
    assert kinds["courier_performance"] == "healthy"  # a single group gives no signal
