"""The Bloom filter before a shuffle of lines loses no key and drops nearly all others."""

from __future__ import annotations

import pytest
from conftest import SF_MID, make_star, rows

from starlens.operators.rootcause import root_cause
from starlens.plans import bloom
from starlens.sources.star import Star


@pytest.fixture(autouse=True)
def at_any_size(spark):
    """Filters for tables of any size, and no join that Spark broadcasts by itself."""
    spark.conf.set("starlens.bloom.minBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("starlens.bloom.minBytes")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffled_rows(df) -> list[int]:
    """Rows written by each shuffle of a finished query."""
    out, todo = [], [df._jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        leaves = todo.pop().collectLeaves()
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            if leaf.getClass().getSimpleName() == "ShuffleQueryStageExec":
                out.append(leaf.shuffle().metrics().apply("shuffleRecordsWritten").value())
            if leaf.getClass().getSimpleName().endswith("QueryStageExec"):
                todo.append(leaf.plan())
    return out


def keyed(spark, start, end):
    return spark.range(start, end).selectExpr("concat('k', id) AS line_id", "id AS more")


def test_no_key_is_lost_and_few_others_stay(spark):
    large, keys = keyed(spark, 0, 60000), keyed(spark, 50000, 53000)
    kept = bloom.might_join(large, keys, "line_id")
    assert kept.columns == large.columns
    assert kept.join(keys.select("line_id"), "line_id", "left_semi").count() == 3000
    assert kept.count() <= 3000 + 57000 // 50


def test_null_repeated_and_no_keys(spark):
    large = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("a", 4), ("c", 5)], "line_id string, more int")
    keys = spark.createDataFrame([("a",), ("a",), (None,)] + [("b",)] * 500, "line_id string")
    assert {("a", 1), ("b", 3), ("a", 4)} <= set(rows(bloom.might_join(large, keys, "line_id")))
    assert None not in [r[0] for r in rows(bloom.might_join(large, keys, "line_id"))]
    assert rows(bloom.might_join(large, keys.limit(0), "line_id")) == []
    assert rows(bloom.might_join(large.limit(0), keys, "line_id")) == []


def test_columns_with_the_filters_names(spark):
    """Columns of the large side come back as they were."""
    large = spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "line_id string, _block int, _words int")
    assert rows(bloom.might_join(large, large.where("line_id = 'a'"), "line_id")) == [("a", 1, 2)]


def test_a_filter_beyond_the_bound_is_left_out(spark):
    large, keys = keyed(spark, 0, 100), keyed(spark, 0, 50)
    spark.conf.set("starlens.broadcast.maxBytes", "100")
    try:
        assert bloom.might_join(large, keys, "line_id").count() == 100
    finally:
        spark.conf.unset("starlens.broadcast.maxBytes")


@pytest.mark.parametrize("scope", [None, {"region": "ASIA"}, {"return_reason": "damaged", "category": "BRASS"}])
def test_root_cause_is_the_same_without_the_filter(spark, scope):
    star = Star.from_fixtures(spark, SF_MID)
    with_filter = rows(root_cause(star, scope))
    spark.conf.set("starlens.broadcast.maxBytes", "0")
    try:
        assert rows(root_cause(Star.from_fixtures(spark, SF_MID), scope)) == with_filter
    finally:
        spark.conf.unset("starlens.broadcast.maxBytes")


def test_lines_meet_the_filter_before_their_exchange(spark):
    plan = root_cause(Star.from_fixtures(spark, SF_MID))._jdf.queryExecution().executedPlan().toString()
    semi = plan.index("LeftSemi, BuildRight")
    above = [line for line in plan[:semi].splitlines() if "Exchange hashpartitioning(line_id" in line]
    assert above, plan


def test_the_shuffle_moves_about_the_returned_lines(spark):
    star = Star.from_fixtures(spark, SF_MID)
    lines, returns = star["fact_order_lines"].select("line_id", "order_id"), star["fact_returns"].select("line_id", "return_id")
    every, returned = lines.count(), returns.count()
    joined = bloom.might_join(lines, returns, "line_id").join(returns, "line_id")
    joined.collect()
    assert returned < every / 2 and returned in shuffled_rows(joined)
    assert every not in shuffled_rows(joined)
    assert any(returned < n <= returned + (every - returned) // 50 for n in shuffled_rows(joined))
    plain = lines.join(returns, "line_id")
    plain.collect()
    assert every in shuffled_rows(plain)


def test_no_filter_where_it_does_not_pay(spark):
    large, keys = keyed(spark, 0, 1000), keyed(spark, 0, 50)
    spark.conf.set("starlens.bloom.minBytes", str(1 << 40))
    assert bloom.might_join(large, keys, "line_id") is large
    spark.conf.set("starlens.bloom.minBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1 << 30))
    assert bloom.might_join(large, keys, "line_id") is large


def test_root_cause_of_an_empty_star(spark):
    assert rows(root_cause(make_star(spark))) == []
