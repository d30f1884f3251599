"""Signal rule on hand-made breakdowns, including boundaries."""

from __future__ import annotations

import pytest
from conftest import rows

from starlens.operators.signals import detect


def _detect(spark, data, **kw):
    df = spark.createDataFrame(data, "label string, v double")
    return sorted(rows(detect(df, "label", "v", **kw), "dimension", "value", "avg", "severity", "type"))


def test_fewer_than_two_groups_gives_nothing(spark):
    assert _detect(spark, [("a", 100.0)]) == []
    assert _detect(spark, []) == []


def test_zero_mean_gives_nothing(spark):
    assert _detect(spark, [("a", 5.0), ("b", -5.0)]) == []


def test_spike_and_drop(spark):
    # mean 25: 70 > 2x mean -> HIGH spike; 10 < 0.5x mean -> drop
    out = _detect(spark, [("a", 70.0), ("b", 10.0), ("c", 10.0), ("d", 10.0)])
    assert out == [
        ("a", 70.0, 25.0, "HIGH", "spike"),
        ("b", 10.0, 25.0, "MEDIUM", "drop"),
        ("c", 10.0, 25.0, "MEDIUM", "drop"),
        ("d", 10.0, 25.0, "MEDIUM", "drop"),
    ]


def test_boundaries_are_strict(spark):
    # mean 10: exactly 1.5x, 2x and 0.5x are not flagged beyond their bands
    out = _detect(spark, [("x15", 15.0), ("x05", 5.0), ("m", 10.0), ("f", 10.0)])
    assert out == []
    # mean 10 with a value of exactly 2x: spike (>1.5x) but MEDIUM (not >2x)
    out = _detect(spark, [("x2", 20.0), ("a", 5.0), ("b", 5.0), ("c", 10.0)])
    assert ("x2", 20.0, 10.0, "MEDIUM", "spike") in out


def test_medium_spike(spark):
    out = _detect(spark, [("a", 17.0), ("b", 10.0), ("c", 9.0), ("d", 4.0)])
    # mean 10: 17 -> MEDIUM spike; 4 -> drop
    assert out == [("a", 17.0, 10.0, "MEDIUM", "spike"), ("d", 4.0, 10.0, "MEDIUM", "drop")]


def test_negative_mean_flags_literally(spark):
    # mean -10: 1.5*mean = -15 < mean, so every value above -15 is a spike;
    # 2*mean = -20 so all of them are HIGH (T9); -15 is not above -15 but is
    # below 0.5*mean = -5, so it is a drop
    out = _detect(spark, [("a", -5.0), ("b", -10.0), ("c", -15.0)])
    assert out == [
        ("a", -5.0, -10.0, "HIGH", "spike"),
        ("b", -10.0, -10.0, "HIGH", "spike"),
        ("c", -15.0, -10.0, "MEDIUM", "drop"),
    ]


def test_avg_rounds_half_away_from_zero(spark):
    # sum 0.05 over 2 groups -> 0.025 -> 0.03; 0.05 is exactly 2x the mean,
    # so a MEDIUM spike (the HIGH bound is strict)
    out = _detect(spark, [("a", 0.05), ("b", 0.0)])
    assert out == [("a", 0.05, 0.03, "MEDIUM", "spike"), ("b", 0.0, 0.03, "MEDIUM", "drop")]
    out = _detect(spark, [("a", -0.05), ("b", 0.0)])
    assert [r[2] for r in out] == [-0.03, -0.03]


def test_partitioned_by_breakdown(spark):
    df = spark.createDataFrame(
        [("p", "a", 70.0), ("p", "b", 10.0), ("q", "a", 1.0), ("q", "b", 1.0), ("r", "z", 9.0)],
        "analysis string, label string, v double",
    )
    out = sorted(rows(detect(df, "label", "v", by=["analysis"]), "analysis", "dimension", "type"))
    # p: mean 40, 70 spike (>60), 10 drop (<20); q: flat; r: one group
    assert out == [("p", "a", "spike"), ("p", "b", "drop")]


@pytest.mark.parametrize("n", [3, 7])
def test_matches_python_rule(spark, n):
    import random

    rnd = random.Random(n)
    data = [(f"g{i}", float(rnd.randint(-50, 200))) for i in range(n)]
    mean = sum(v for _, v in data) / n
    expect = []
    if mean != 0:
        for label, v in data:
            if v > mean * 1.5:
                expect.append((label, "HIGH" if v > mean * 2 else "MEDIUM", "spike"))
            elif v < mean * 0.5:
                expect.append((label, "MEDIUM", "drop"))
    got = [(d, s, t) for d, _, _, s, t in _detect(spark, data)]
    assert got == sorted(expect)
