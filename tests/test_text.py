"""H9, H14 helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from starlens.functions.text import event_ts, short_label, ts_text


def test_short_label(spark):
    df = spark.createDataFrame([("0123456789abc",), ("abc",)], "id string")
    assert [r.s for r in df.select(short_label(F.col("id")).alias("s")).collect()] == ["01234567", "abc"]


def test_event_time_text_round_trip(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:07.179575",), ("2024-01-02 10:20:30",), ("not a time",), (None,)], "t string"
    )
    out = [r[0] for r in df.select(event_ts(F.col("t"))).collect()]
    assert out == [
        dt.datetime(2024, 1, 1, 0, 0, 7, 179575),
        dt.datetime(2024, 1, 2, 10, 20, 30),
        None,
        None,
    ]
    back = [r[0] for r in df.select(ts_text(event_ts(F.col("t")))).collect()]
    assert back[:2] == ["2024-01-01 00:00:07.179575", "2024-01-02 10:20:30"]
