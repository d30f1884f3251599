"""Streaming ingest, replay safety, rejects, tables."""

from __future__ import annotations

import os
import tempfile

import pytest
from conftest import SF_SMALL, rows

from starlens.sources.schemas import KEYS, SCHEMAS, TOPICS
from starlens.sources.star import Star
from starlens.sources.star import key_ranges
from starlens.sources.tables import create_tables, recent_orders, truncate_all
from starlens.streaming import ingest
from starlens.streaming.ingest import BatchSink, JdbcBatchSink, decode, publish, run_ingest, start_all, start_table


@pytest.fixture()
def base():
    return tempfile.mkdtemp(prefix="starlens-test-")


def _write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_schemas_and_topics():
    assert len(SCHEMAS) == 14
    assert KEYS["fact_order_lines"] == "line_id"
    assert TOPICS["dim_regions"] == "topic_dim_regions"
    assert SCHEMAS["fact_inventory_transactions"]["quantity_change"].dataType.typeName() == "integer"


def test_decode_and_rejects(spark, base):
    topic = f"{base}/topics/{TOPICS['fact_order_lines']}"
    _write_lines(topic, "part-0.json", [
        '{"line_id": "l1", "order_id": "o1", "sku_id": "s1", "warehouse_id": "w1", "quantity": 2, "line_value": 9.5}',
        "not json",
        "",
        '{"line_id": null, "order_id": "o2"}',
        '{"line_id": "l2", "quantity": 4.5, "extra": "dropped"}',
    ])
    q = start_table(spark, "fact_order_lines", f"{base}/star", source=f"{base}/topics",
                    checkpoint_root=f"{base}/ckpt", available_now=True)
    q.awaitTermination()
    stored = spark.read.parquet(f"{base}/star/fact_order_lines")
    got = sorted(rows(stored.select(*SCHEMAS["fact_order_lines"].names)))
    assert got == [
        ("l1", "o1", "s1", "w1", 2, 9.5),
        ("l2", None, None, None, None, None),  # wrong-typed field -> null
    ]
    rejects = sorted(r[0] for r in spark.read.parquet(f"{base}/star/_rejects/fact_order_lines").select("value").collect())
    assert rejects == sorted(["", '{"line_id": null, "order_id": "o2"}', "not json"])


def test_replayed_batch_replaces_itself(spark, base):
    raw = spark.createDataFrame(
        [('{"region_id": "r1", "region_name": "West"}',), ('{"region_id": "r2", "region_name": "East"}',)],
        "value string",
    )
    batch = decode(raw, "dim_regions")
    sink = BatchSink(f"{base}/star", "dim_regions")
    sink(batch, 0)
    sink(batch, 0)  # replay after a failure: same batch id
    stored = spark.read.parquet(f"{base}/star/dim_regions")
    assert stored.count() == 2
    sink(batch, 1)  # a new batch with the same events appends (at-least-once input)
    assert spark.read.parquet(f"{base}/star/dim_regions").count() == 4


def test_empty_batch_stores_nothing(spark, base):
    raw = spark.createDataFrame([], "value string")
    create_tables(spark, f"{base}/star")
    BatchSink(f"{base}/star", "dim_regions")(decode(raw, "dim_regions"), 0)
    assert Star.from_parquet(spark, f"{base}/star")["dim_regions"].count() == 0
    assert not os.path.exists(f"{base}/star/_rejects/dim_regions")


def _regions(*ids):
    return ['{"region_id": "%s", "region_name": "West"}' % i for i in ids]


def _stored(spark, base):
    return sorted(r.region_id for r in Star.from_parquet(spark, f"{base}/star")["dim_regions"].collect())


def test_a_new_checkpoint_keeps_stored_rows(spark, base):
    """A second stream starts again at batch 0 and must not touch the first one's batch 0."""
    for k, ids in enumerate((("r1", "r2"), ("r3",))):
        _write_lines(f"{base}/topics{k}/{TOPICS['dim_regions']}", "part-0.json", [*_regions(*ids), f"bad {k}"])
        run_ingest(spark, f"{base}/star", ["dim_regions"], source=f"{base}/topics{k}", checkpoint_root=f"{base}/ckpt{k}",
                   available_now=True)
    assert _stored(spark, base) == ["r1", "r2", "r3"]
    assert sorted(r.value for r in spark.read.parquet(f"{base}/star/_rejects/dim_regions").collect()) == ["bad 0", "bad 1"]
    # a replay of the first stream's batch, by a new process with its checkpoint, replaces that batch only
    again = decode(spark.read.text(f"{base}/topics0/{TOPICS['dim_regions']}"), "dim_regions")
    BatchSink(f"{base}/star", "dim_regions").bind(f"{base}/ckpt0/dim_regions")(again, 0)
    assert _stored(spark, base) == ["r1", "r2", "r3"]
    assert spark.read.parquet(f"{base}/star/_rejects/dim_regions").count() == 2


def test_a_late_backfill_raises(spark, base):
    star = Star.from_fixtures(spark, SF_SMALL)
    publish(star["fact_order_lines"].repartition(40), "fact_order_lines", f"{base}/topics")
    with pytest.raises(TimeoutError, match="fact_order_lines"):
        run_ingest(spark, f"{base}/star", ["fact_order_lines"], source=f"{base}/topics", checkpoint_root=f"{base}/ckpt",
                   available_now=True, timeout_s=2, max_files=1)
    # what was stored stays, and a rerun completes it
    run_ingest(spark, f"{base}/star", ["fact_order_lines"], source=f"{base}/topics", checkpoint_root=f"{base}/ckpt",
               available_now=True)
    stored = Star.from_parquet(spark, f"{base}/star")["fact_order_lines"]
    assert stored.exceptAll(star["fact_order_lines"]).count() == 0 and stored.count() == star["fact_order_lines"].count()


def test_timeouts_are_seconds(spark, monkeypatch):
    seen = []

    class Query:
        name, isActive = "q", False

        def awaitTermination(self, timeout=None):
            seen.append(timeout)
            return True

        def exception(self):
            return None

    monkeypatch.setattr(ingest, "start_all", lambda *a, **kw: [Query(), Query()])
    run_ingest(spark, "x", available_now=True, timeout_s=120)
    assert all(110 < t <= 120 for t in seen)


def test_micro_batches_are_bounded(spark, base):
    star = Star.from_fixtures(spark, SF_SMALL)
    publish(star["fact_shipments"].repartition(8), "fact_shipments", f"{base}/topics")
    run_ingest(spark, f"{base}/star", ["fact_shipments"], source=f"{base}/topics", checkpoint_root=f"{base}/ckpt",
               available_now=True, max_files=2)
    stored = spark.read.parquet(f"{base}/star/fact_shipments")
    assert stored.select("batch_id").distinct().count() >= 4 and stored.count() == star["fact_shipments"].count()


def test_tables_exist_before_the_first_event(spark, base):
    assert len(create_tables(spark, f"{base}/star")) == 14 and create_tables(spark, f"{base}/star") == []
    _write_lines(f"{base}/topics/{TOPICS['dim_regions']}", "part-0.json", _regions("r1"))
    run_ingest(spark, f"{base}/star", ["dim_regions"], source=f"{base}/topics", checkpoint_root=f"{base}/ckpt", available_now=True)
    star = Star.from_parquet(spark, f"{base}/star")
    from starlens.operators.analyses import ANALYSES

    assert star["dim_regions"].count() == 1
    for a in ANALYSES.values():
        assert a.run(star, {}).collect() == []
    empty = Star.from_parquet(spark, f"{base}/nowhere")
    assert all(empty[n].count() == 0 for n in SCHEMAS)


def test_a_storage_failure_is_not_an_empty_table(spark, base):
    os.makedirs(f"{base}/star/dim_regions")
    with open(f"{base}/star/dim_regions/part-0.parquet", "w") as fh:
        fh.write("not parquet")
    with pytest.raises(Exception):
        Star.from_parquet(spark, f"{base}/star")["dim_regions"].collect()


def test_key_ranges_cut_a_table(spark):
    keys = ["", "0", "1", "1a", "9", "P12", "a", "f0", "zz", "~", "Ä", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for parts in (1, 2, 7, 16, 40):
        met = " + ".join(f"int(coalesce({c}, false))" for c in key_ranges("k", parts))
        assert [r[0] for r in df.selectExpr(met).collect()] == [1] * len(keys)


def test_jdbc_sink_checks_the_first_batch_only(spark, base, monkeypatch):
    """The database is stood in for by a list: one batch may be a replay, later ones cannot."""
    stored, reads = ["r1"], []

    def keys(self, session):
        reads.append(len(stored))
        return session.createDataFrame([(k,) for k in stored], "region_id string")

    monkeypatch.setattr(JdbcBatchSink, "stored_keys", keys)
    monkeypatch.setattr(JdbcBatchSink, "append", lambda self, good: stored.extend(r.region_id for r in good.collect()))
    sink = JdbcBatchSink("jdbc:none", "dim_regions", {}, f"{base}/rejects")
    raw = lambda *ids: decode(spark.createDataFrame([(x,) for x in _regions(*ids)], "value string"), "dim_regions")
    sink(raw("r1", "r2"), 4)
    sink(raw("r3"), 5)
    assert sorted(stored) == ["r1", "r2", "r3"] and reads == [1]


def test_each_table_gets_a_sink_of_its_own(spark, monkeypatch):
    made = []
    monkeypatch.setattr(ingest, "start_table", lambda spark, t, root, sink_for, **kw: made.append(sink_for(t)))
    start_all(spark, "x", sink_for=lambda t: JdbcBatchSink("jdbc:none", t, {}, "y"))
    assert [s.table for s in made] == list(SCHEMAS)


def test_publish_ingest_all_tables_equals_batch(spark, base):
    star = Star.from_fixtures(spark, SF_SMALL)
    for name in SCHEMAS:
        publish(star[name], name, f"{base}/topics")
    queries = start_all(spark, f"{base}/star", source=f"{base}/topics", checkpoint_root=f"{base}/ckpt",
                        available_now=True)
    for q in queries:
        q.awaitTermination()
    stored = Star.from_parquet(spark, f"{base}/star")
    for name in SCHEMAS:
        assert stored[name].exceptAll(star[name]).count() == 0, name
        assert star[name].exceptAll(stored[name]).count() == 0, name
    # restart from the checkpoints: nothing new, nothing duplicated
    queries = start_all(spark, f"{base}/star", tables=["fact_payments"], source=f"{base}/topics",
                        checkpoint_root=f"{base}/ckpt", available_now=True)
    queries[0].awaitTermination()
    assert Star.from_parquet(spark, f"{base}/star")["fact_payments"].count() == star["fact_payments"].count()
    # truncation empties every table
    assert set(truncate_all(spark, f"{base}/star")) == set(SCHEMAS)
    emptied = Star.from_parquet(spark, f"{base}/star")
    assert all(emptied[n].count() == 0 for n in SCHEMAS)


def test_recent_orders(spark):
    star = Star.from_fixtures(spark, SF_SMALL)
    assert recent_orders(star).count() == 20
    assert recent_orders(star, 500).count() == 100
    assert recent_orders(star, 0).count() == 0
    with pytest.raises(ValueError):
        recent_orders(star, -1)
    ts = [r.event_timestamp for r in recent_orders(star, 50).collect()]
    assert ts == sorted(ts, reverse=True)


def test_processing_time_trigger_picks_up_new_files(spark, base):
    topic = f"{base}/topics/{TOPICS['dim_payment_methods']}"
    _write_lines(topic, "part-0.json", ['{"method_id": "1", "method_name": "URGENT"}'])
    q = start_table(spark, "dim_payment_methods", f"{base}/star", source=f"{base}/topics",
                    checkpoint_root=f"{base}/ckpt", processing_time="1 second")
    try:
        q.processAllAvailable()
        _write_lines(topic, "part-1.json", ['{"method_id": "2", "method_name": "HIGH"}'])
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(rows(spark.read.parquet(f"{base}/star/dim_payment_methods").select("method_id", "method_name")))
    assert got == [("1", "URGENT"), ("2", "HIGH")]


def test_run_ingest_waits_for_all_streams(spark, base):
    star = Star.from_fixtures(spark, SF_SMALL)
    tables = ["dim_regions", "fact_returns"]
    for name in tables:
        publish(star[name], name, f"{base}/topics")
    queries = run_ingest(spark, f"{base}/star", tables=tables, source=f"{base}/topics",
                         checkpoint_root=f"{base}/ckpt", available_now=True, timeout_s=120)
    assert all(not q.isActive for q in queries)
    for name in tables:
        stored = spark.read.parquet(f"{base}/star/{name}").select(*SCHEMAS[name].names)
        assert stored.exceptAll(star[name]).count() == 0
        assert star[name].exceptAll(stored).count() == 0
