"""Each event once, partial states, field faults, versions of the tables."""

from __future__ import annotations

import json
import os
import re
import tempfile

import pytest
from conftest import SF_SMALL, rows

from starlens.plans.report import report_long
from starlens.sources import tables
from starlens.sources.schemas import SCHEMAS, TOPICS
from starlens.sources.star import Star
from starlens.sources.tables import create_tables, truncate_all
from starlens.sources.versions import next_version, switch_version, version_root
from starlens.streaming import ingest, scenarios
from starlens.streaming.fields import decode_fields, drift, merged_drift
from starlens.streaming.ingest import BatchSink, decode, publish, run_ingest
from starlens.streaming.sinks import STATES, FieldSink, KeyedSink, StateSink, read_state, report_from_states
from tests.test_lattice import random_star


@pytest.fixture()
def base():
    return tempfile.mkdtemp(prefix="starlens-test-")


def events(spark, *values):
    return spark.createDataFrame([(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def region(i, name="n"):
    return {"region_id": f"r{i}", "region_name": name}


def batch(spark, *values):
    return decode(events(spark, *values), "dim_regions")


def stored(spark, base):
    return sorted(rows(Star.from_parquet(spark, base)["dim_regions"].select("region_id", "region_name")))


def test_each_key_is_stored_once_over_batches_replays_and_streams(spark, base):
    sink = KeyedSink(base, "dim_regions", buckets=3)
    sink(batch(spark, region(1, "b"), region(1, "a"), region(2), "no json"), 0)
    sink(batch(spark, region(2, "later"), region(3)), 1)
    assert stored(spark, base) == [("r1", "a"), ("r2", "n"), ("r3", "n")]
    sink(batch(spark, region(1, "b"), region(1, "a"), region(2), "no json"), 0)  # a replay finds what the first run found
    sink(batch(spark, region(2, "later"), region(3)), 1)
    sink(batch(spark, region(1), region(2), region(3)), 2)  # nothing new
    KeyedSink(base, "dim_regions", buckets=3)(batch(spark, region(3, "other"), region(4)), 0)
    assert stored(spark, base) == [("r1", "a"), ("r2", "n"), ("r3", "n"), ("r4", "n")]
    assert spark.read.parquet(f"{base}/_rejects/dim_regions").count() == 1


def test_the_plan_of_a_batch_reads_the_index_and_not_the_table(spark, base):
    sink = KeyedSink(base, "dim_regions", buckets=3)
    sink(batch(spark, region(1)), 0)
    good = batch(spark, region(1), region(2)).where("_ok").select(*SCHEMAS["dim_regions"].names)
    files = sink.fresh(good, 1).inputFiles()
    assert files and all("/_keys/" in f for f in files)
    assert [r.region_id for r in sink.fresh(good, 1).collect()] == ["r2"]


def test_a_replay_after_a_crash_between_rows_and_index(spark, base, monkeypatch):
    sink = KeyedSink(base, "dim_regions", buckets=2)
    monkeypatch.setattr(sink, "index", lambda s: (_ for _ in ()).throw(RuntimeError("lost")) if sink.lost else KeyedSink.index(sink, s))
    sink.lost = False
    sink(batch(spark, region(1)), 0)
    real = sink.known

    def known(s, b):
        out = real(s, b)
        sink.lost = True
        return out

    monkeypatch.setattr(sink, "known", known)
    with pytest.raises(RuntimeError):
        sink(batch(spark, region(1, "x"), region(2)), 1)
    sink.lost = False
    monkeypatch.setattr(sink, "known", real)
    sink(batch(spark, region(1, "x"), region(2)), 1)
    sink(batch(spark, region(2, "y"), region(5)), 2)
    assert stored(spark, base) == [("r1", "n"), ("r2", "n"), ("r5", "n")]


def test_states_add_up_to_the_report_and_no_fact_is_read(spark, base):
    star = random_star(spark, 5)
    create_tables(spark, base)
    sinks = {t: StateSink(base, t) for t in SCHEMAS}
    for t, sink in sinks.items():
        parts = star[t].randomSplit([0.4, 0.4, 0.2], 3) if t.startswith("fact_") else [star[t]]
        for k, part in enumerate(parts):
            sink.store(part, k)
        sink.store(parts[0], 0)  # a replayed batch replaces its states
    report = report_from_states(spark, base)
    assert sorted(map(str, report.collect())) == sorted(map(str, report_long(Star.from_parquet(spark, base)).collect()))
    assert not any("/fact_" in f for f in report.inputFiles())
    assert sorted(STATES) == sorted(t for t in SCHEMAS if t.startswith("fact_"))
    assert read_state(spark, tempfile.mkdtemp(), "clicks").count() == 0


def test_faults_by_field(spark):
    line = {"line_id": "l", "order_id": "o", "sku_id": "s", "warehouse_id": "w", "quantity": 2, "line_value": 9.5}
    given = [line, line | {"line_value": 3}, line | {"line_value": None}, line | {"quantity": "2"}, line | {"quantity": 2.5}, line | {"quantity": 2**40},
             line | {"sku_id": 7, "line_value": "x"}, line | {"b": 1, "a": {"c": 2}}, line | {"line_id": None}, {"line_id": "only"}, "cut {", "[1]", "3", None, ""]
    got = decode_fields(events(spark, *given), "fact_order_lines")
    reasons = [r._reason for r in got.collect()]
    assert reasons == [None, None, None, "wrong type: quantity", "wrong type: quantity", "wrong type: quantity", "wrong type: sku_id, line_value", None, "no key",
                       None, "not json", "not an object", "not an object", "not json", "not json"]
    faults = {(r.field, r.kind): r.n for r in drift(got).collect()}
    assert faults[("a", "unknown")] == faults[("b", "unknown")] == 1 and faults[("quantity", "wrong type")] == 3
    assert faults[("line_id", "missing")] == 1 and faults[("order_id", "missing")] == 1 and faults[(None, "not json")] == 3
    assert rows(got.where("_ok").select(*SCHEMAS["fact_order_lines"].names))[:3] == [
        ("l", "o", "s", "w", 2, 9.5), ("l", "o", "s", "w", 2, 3.0), ("l", "o", "s", "w", 2, None)]
    assert merged_drift([drift(got), drift(got)]).where("field = 'quantity'").first().n == 6


def test_truncation_is_one_step(spark, base, monkeypatch):
    sink = BatchSink(base, "dim_regions")
    create_tables(spark, base)
    sink.store(batch(spark, region(1)).select(*SCHEMAS["dim_regions"].names), 0)
    before = Star.from_parquet(spark, base)["dim_regions"]
    monkeypatch.setattr(tables, "switch_version", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        truncate_all(spark, base)
    assert stored(spark, base) == [("r1", "n")] and version_root(spark, base) == base
    monkeypatch.undo()
    truncate_all(spark, base)
    assert stored(spark, base) == [] and before.count() == 1  # a reader that began before goes on
    sink.store(batch(spark, region(2)).select(*SCHEMAS["dim_regions"].names), 1)
    assert stored(spark, base) == [("r2", "n")]
    number, _ = next_version(spark, base)
    switch_version(spark, base, number)
    with pytest.raises(RuntimeError):
        switch_version(spark, base, number)


def counted(spark, table, *values):
    """A decoded batch, and how many events were decoded."""
    seen = spark.sparkContext.accumulator(0)

    def tell(v):
        seen.add(1)
        return (v,)

    raw = spark.createDataFrame(spark.sparkContext.parallelize([json.dumps(v) for v in values], 2).map(tell), "value string")
    return raw, seen


def test_a_batch_is_decoded_by_field_once(spark, base):
    raw, seen = counted(spark, "dim_regions", region(1), {"region_id": 7}, {"region_name": "keyless"}, {**region(2), "note": "x"})
    FieldSink(base, "dim_regions")(decode_fields(raw, "dim_regions"), 0)
    assert seen.value == 4
    assert stored(spark, base) == [("r1", "n"), ("r2", "n")]
    assert sorted(r.reason for r in spark.read.parquet(f"{base}/_rejects/dim_regions").collect()) == ["no key", "wrong type: region_id"]
    drifts = {(r.field, r.kind): r.n for r in spark.read.parquet(f"{base}/_drift/dim_regions").collect()}
    assert drifts[("note", "unknown")] == 1 and drifts[("country", "missing")] == 4


def test_states_do_not_decode_events_again(spark, base):
    lines = [{"line_id": f"l{i}", "order_id": "o", "sku_id": f"s{i % 2}", "line_value": 1.5} for i in range(6)]
    raw, seen = counted(spark, "fact_order_lines", *lines)
    StateSink(base, "fact_order_lines")(decode(raw, "fact_order_lines"), 0)
    assert seen.value <= 12  # stored, and looked at for rejects
    assert sorted((r.sku_id, float(r.exact)) for r in read_state(spark, base, "revenue").collect()) == [("s0", 4.5), ("s1", 4.5)]
    bad = spark.createDataFrame([("no json",)], "value string")
    StateSink(base, "fact_order_lines")(decode(bad, "fact_order_lines"), 1)  # a batch without good rows
    assert read_state(spark, base, "lines").count() == 6


def test_a_keyed_batch_is_not_decoded_for_keys_and_rows(spark, base):
    raw, seen = counted(spark, "dim_regions", *[region(i) for i in range(6)])
    KeyedSink(base, "dim_regions", buckets=2)(decode(raw, "dim_regions"), 0)
    assert seen.value <= 12
    assert len(stored(spark, base)) == 6


def test_scenarios_publish_from_all_tasks(spark, base, monkeypatch):
    sent = []
    monkeypatch.setattr(scenarios, "publish", lambda rows, table, target: (sent.append(rows._jdf.queryExecution().optimizedPlan().toString()), publish(rows, table, target)))
    assert scenarios.ingest_duplicates(spark, SF_SMALL).count() == 1500
    scenarios._published(spark, SF_SMALL, base, 0)
    scenarios._published(spark, SF_SMALL, base, 1)
    assert len(sent) == 3 + 14 + 7 and not any("Repartition" in plan for plan in sent)
    assert spark.read.text(f"{base}/topics/{TOPICS['fact_payments']}").count() == 1500


def test_topic_files_are_compressed_and_cut(spark, base, monkeypatch):
    monkeypatch.setattr(ingest, "FILE_EVENTS", 10)
    rows25 = spark.createDataFrame([(f"r{i}", "n", None) for i in range(25)], SCHEMAS["dim_regions"]).coalesce(1)
    publish(rows25, "dim_regions", f"{base}/topics")
    files = spark.read.text(f"{base}/topics/{TOPICS['dim_regions']}").inputFiles()
    assert len(files) == 3 and all(f.endswith(".txt.lz4") for f in files)
    run_ingest(spark, f"{base}/star", ["dim_regions"], source=f"{base}/topics", checkpoint_root=f"{base}/ckpt", available_now=True)
    assert len(stored(spark, f"{base}/star")) == 25


def test_a_part_of_the_events_goes_before_the_next_is_sent(spark, monkeypatch):
    found = []

    def sent(rows, table, target):
        if table == "fact_payments":
            found.append(os.path.exists(f"{target.removeprefix('file:')}/{TOPICS[table]}"))
        publish(rows, table, target)

    monkeypatch.setattr(scenarios, "publish", sent)
    monkeypatch.setattr(scenarios, "PART_EVENTS", 2500)  # of 6,000 lines
    report = scenarios.report_incremental(spark, SF_SMALL)
    assert found == [False] * 3
    assert sorted(map(str, report.collect())) == sorted(map(str, report_long(Star.from_fixtures(spark, SF_SMALL)).collect()))


def test_states_of_keys_are_joined_unsummed_and_stored_small(spark, base):
    star = random_star(spark, 6)
    create_tables(spark, base)
    for t in SCHEMAS:
        StateSink(base, t).store(star[t], 0)
    plan = report_from_states(spark, base)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[(line_id#\d+, sku_id|order_id#\d+, customer_id)", plan)
    states = spark.read.parquet(f"{base}/_states/lines").inputFiles()
    assert states and all(f.endswith(".zstd.parquet") or f.endswith(".zstd") or ".zstd." in f for f in states)
