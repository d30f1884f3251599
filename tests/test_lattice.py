"""Reports for a table of scopes against the same report, scope by scope."""

from __future__ import annotations

import json
import random
import time
from functools import reduce

import pytest
from conftest import make_star
from pyspark.sql import functions as F

from starlens.functions.scope import SCOPE_KEYS
from starlens.operators.questions import question_scope
from starlens.plans.lattice import Lattice, asked_keys, report_by_question, reports_for
from starlens.plans.report import report_long
from starlens.session import freed_shuffles
from starlens.sources.star import Star

VALUES = {"region": ["R1", "R2", "nowhere"], "city": ["C1", "C2"], "category": ["K1", "K2"], "courier_name": ["A", "B"], "return_reason": ["x", "y"],
          "device_type": ["m", "d"], "payment_method": ["card", "cash"], "payment_status": ["failed", "ok"]}


def random_star(spark, seed):
    """Repeated dimension rows and headers, dangling keys, nulls, a NaN."""
    rng = random.Random(seed)
    some = lambda xs: rng.choice([*xs, None])
    orders = [f"o{i}" for i in range(30)]
    regions = [("r1", "R1", None), ("r2", "R2", None), ("r2", "R2", None), ("r3", None, None)]
    addresses = [(f"a{i}", some(["C1", "C2"]), some(["r1", "r2", "r3", "r9"])) for i in range(8)] + [("a1", "C1", "r1")]
    customers = [(f"c{i}", some([f"a{k}" for k in range(9)]), None) for i in range(12)] + [("c3", "a1", None), ("c3", "a2", None)]
    headers = [(o, some([f"c{k}" for k in range(14)]), 1.5, None) for o in orders] + [("o3", "c3", 2.0, None)]
    skus = [(f"s{i}", some(["k1", "k2"]), 1.0) for i in range(6)] + [("s1", "k2", 1.0)]
    lines = [(f"l{i}", some([*orders, "gone"]), some([f"s{k}" for k in range(7)]), "w1", 1, rng.choice([1.25, 2.5, None, 10.01])) for i in range(80)]
    lines.append(("l3", "o3", "s1", "w1", 1, 4.0))
    if seed % 2:
        lines.append(("l99", "o1", "s2", "w1", 1, float("nan")))
    returns = [(some([f"t{i}"] * 5), some([f"l{k}" for k in range(85)]), some(["x", "y"]), None, None) for i in range(50)]
    payments = [(f"p{i}", some([*orders, "gone"]), some(["m1", "m2", "m9"]), 1.0, some(["failed", "failed", "ok"]), some(["f1", "f2"]), None) for i in range(70)]
    shipments = [(some([f"h{i}"] * 5), some([*orders, "gone"]), some(["A", "B"]), "dispatched", None) for i in range(60)]
    stock = [(f"i{i}", "s1", some(["w1", "w2", "w3"]), "stock_added", some([1, -2, 5]), None) for i in range(30)]
    clicks = [(f"e{i}", some([f"c{k}" for k in range(14)]), "s1", some(["m", "d"]), some(["view", "buy"]), None) for i in range(60)]
    return make_star(
        spark, dim_regions=regions, dim_customer_addresses=addresses, dim_customers=customers, dim_skus=skus,
        dim_categories=[("k1", "K1"), ("k2", "K2"), ("k2", "K2")], dim_payment_methods=[("m1", "card"), ("m2", "cash"), ("m2", "cash")],
        dim_warehouses=[("w1", "r1"), ("w2", "r2"), ("w2", "r1")], fact_order_headers=headers, fact_order_lines=lines, fact_payments=payments,
        fact_shipments=shipments, fact_returns=returns, fact_inventory_transactions=stock, fact_user_clickstream=clicks)


def shown(rows):
    return sorted(map(str, (tuple(r) for r in rows)))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_report_of_every_scope(spark, seed):
    star, rng = random_star(spark, seed), random.Random(seed)
    scopes = [{}, {k: v[0] for k, v in VALUES.items()}, {"unknown": "z", "region": "R2"}]
    scopes += [{k: rng.choice(VALUES[k]) for k in sorted(rng.sample(sorted(VALUES), rng.randint(1, 3)))} for _ in range(7)]
    table = spark.createDataFrame([(json.dumps(s),) for s in scopes] * 2, "scope_json string")
    got = {}
    for r in reports_for(star, table).collect():
        got.setdefault(r.scope_json, []).append((r.analysis, r.dimension, r.value))
    for s in scopes:
        assert shown(got.get(json.dumps(s), [])) == shown(report_long(star, s).collect()), s
    assert set(SCOPE_KEYS) == set(VALUES)


def test_odd_scopes_and_no_scopes(spark):
    star = random_star(spark, 3)
    table = spark.createDataFrame([(None,), ("no json",), ("{}",)], "scope_json string")
    got = reports_for(star, table)
    want = shown(report_long(star).collect())
    assert shown(got.where("scope_json = '{}'").drop("scope_json").collect()) == want
    assert shown(got.where("scope_json = 'no json'").drop("scope_json").collect()) == want
    assert reports_for(star, table.where("false")).count() == 0
    assert asked_keys(spark.sql("select map('a', '1', 'b', '2') as scope union all select map('b', '3', 'a', '4')")) == {frozenset("ab")}


def test_questions_of_one_scope_share_its_report(spark):
    star = random_star(spark, 4)
    questions = spark.createDataFrame([(1, "what of R1"), (2, "and R1?"), (3, "nothing"), (4, "R2 with courier B please")], "qid long, text string")
    got = {}
    for r in report_by_question(star, questions, ("qid",)).collect():
        got.setdefault(r.qid, []).append((r.analysis, r.dimension, r.value))
    assert shown(got[1]) == shown(got[2]) == shown(report_long(star, {"region": "R1"}).collect())
    assert shown(got[3]) == shown(report_long(star).collect())
    assert shown(got[4]) == shown(report_long(star, {"region": "R2", "courier_name": "B"}).collect())


def test_a_rank_without_a_single_task(spark):
    from starlens.plans.rank import with_rank

    rows = spark.range(0, 5000, 1, 13).select(F.col("id"), F.pmod(F.xxhash64("id"), F.lit(97)).alias("m"))
    ranked = with_rank(rows, [F.desc_nulls_first("m"), F.asc("id")])
    assert "Window" not in ranked._jdf.queryExecution().executedPlan().toString()
    want = sorted(((r.id, r.m) for r in rows.collect()), key=lambda r: (-r[1], r[0]))
    assert [(r.id, r.m) for r in sorted(ranked.collect(), key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 5001))
    assert with_rank(rows.where("false"), [F.asc("id")]).count() == 0


def test_distinct_orders_are_not_shuffled_for_every_grouping_set(spark):
    star = random_star(spark, 5)
    asked = [frozenset(), frozenset({"region"}), frozenset({"city"}), frozenset({"region", "city"}), frozenset({"category"}), frozenset({"category", "city"})]
    for cells in Lattice(star, asked).orders():
        assert "Expand" not in cells._jdf.queryExecution().optimizedPlan().toString()


def test_question_ngrams_meet_a_small_vocabulary_unshuffled(spark):
    star = random_star(spark, 6)
    questions = spark.createDataFrame([(1, "what of R1"), (2, "C2 please")], "qid long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scopes = question_scope(star, questions, ("qid",))
        assert "ResolvedHint (strategy=broadcast)" in scopes._jdf.queryExecution().analyzed().toString() or "strategy=broadcast" in scopes._jdf.queryExecution().optimizedPlan().toString()
        assert {r.qid: r.scope_json for r in scopes.collect()} == {1: '{"region":"R1"}', 2: '{"city":"C2"}'}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_line_is_read_once_for_orders_and_revenue(spark):
    star, seen = random_star(spark, 7), spark.sparkContext.accumulator(0)

    def tell(r):
        seen.add(1)
        return r

    lines = star["fact_order_lines"]
    star = Star(spark, {**star, "fact_order_lines": spark.createDataFrame(lines.rdd.map(tell), lines.schema)})
    lattice = Lattice(star, [frozenset(), frozenset({"region"}), frozenset({"category"}), frozenset({"category", "city"})])
    cells = reduce(lambda a, b: a.unionByName(b), [*lattice.orders(), *lattice.revenue()])
    assert cells.count() > 0 and seen.value == lines.count()


def test_sums_keep_every_stored_decimal(spark):
    lines = [("l1", "o1", "s1", "w", 1, 0.0033333333), ("l2", "o1", "s1", "w", 1, 0.0016666666), ("l3", "o2", "s1", "w", 1, 0.0000000001), ("l4", "o1", "s2", "w", 1, -0.005)]
    star = make_star(
        spark, dim_regions=[("r1", "R1", None)] * 3, dim_customer_addresses=[("a1", "C1", "r1")], dim_customers=[("c1", "a1", None)], dim_skus=[("s1", "k1", 1.0), ("s2", "k2", 1.0)],
        dim_categories=[("k1", "K1"), ("k2", "K2")], fact_order_headers=[("o1", "c1", 1.0, None), ("o2", "c1", 1.0, None)], fact_order_lines=lines)
    for scope in ({}, {"region": "R1"}):
        table = spark.createDataFrame([(json.dumps(scope),)], "scope_json string")
        assert shown(reports_for(star, table).drop("scope_json").collect()) == shown(report_long(star, scope).collect())


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if f.endswith(".data")}


def left(spark, before):
    """The shuffle files made since; Spark removes them in the background."""
    for _ in range(100):
        if not (some := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return some


def test_the_files_of_a_step_go_with_it(spark):
    star, held = random_star(spark, 8), []  # held: no garbage of the driver takes the files
    questions = spark.createDataFrame([(1, "what of R1"), (2, "C2 please"), (3, "K1 by card")], "qid long, text string")
    before = shuffle_files(spark)
    held.append(report_by_question(star, questions, ("qid",)))
    assert not left(spark, before)
    assert {r.qid for r in held[0].collect()} == {1, 2, 3}
    was = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    with pytest.raises(RuntimeError), freed_shuffles(spark):
        raise RuntimeError
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == was
