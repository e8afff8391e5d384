"""Streams give what batches give, once, however often they are cut or repeated."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from orderweave import schemas as S
from orderweave.functions import rules
from orderweave.operators import allocate, filters, records
from orderweave.session import scratch
from orderweave.sources.driver_tables import PARTITIONS
from orderweave.sources.snapshots import SnapshotStore
from orderweave.streaming import flows, runs


def store_for(tables):
    return runs.open_store(SnapshotStore(tables.spark, scratch(tables.spark, "store")), tables.inventory(), tables.person())


def staged(tables, parts):
    """Records in ``parts`` files, in request order, so that micro-batches follow the order of the requests."""
    path = scratch(tables.spark, "staged")
    stored = tables.record()
    n = stored.agg(F.max("request_id")).first()[0] + 1
    for i in range(parts):
        low, high = n * i // parts, n * (i + 1) // parts
        stored.where(F.col("request_id").between(low, high - 1)).coalesce(1).write.mode("append").parquet(path)
    return path, stored.schema


def state(store):
    outcome = {r.request_id: (r.result, r.reason) for r in store.load_log("outcome").collect()}
    return (outcome, {r.product_id: r.qty for r in store.load("inventory").collect()},
            {r.person_id: r.balance for r in store.load("person").collect()},
            store.load_log("dead_letter").count())


def test_many_micro_batches_equal_one(spark, tables):
    path, schema = staged(tables, 3)
    one, many = store_for(tables), store_for(tables)
    first = runs.process_run(one, flows.file_stream(spark, path, schema), "r", tables.product()).collect()
    second = runs.process_run(many, flows.file_stream(spark, path, schema, max_files=1), "r", tables.product()).collect()
    assert many.load_log("control").select("batch_id").distinct().count() == 3
    assert first == second
    assert state(one) == state(many)

    good = {r.request_id for r in tables.record().collect() if r.request_id % 101}
    expected = allocate.allocate_requests(
        filters.lookup_by_ids(tables.request().drop("ts"), "request_id", good), tables.inventory(), tables.product(),
        tables.person())
    assert state(one)[0] == {r.request_id: (r.result, r.reason) for r in expected.collect()}


def test_replayed_batch_changes_nothing_and_closed_run_is_refused(spark, tables):
    store = store_for(tables)
    batch = tables.delivery().drop("attempt", "ts")
    assert runs.handle_batch(store, batch, "r", 0, tables.product())
    before = state(store)
    assert not runs.handle_batch(store, batch, "r", 0, tables.product())
    assert runs.handle_batch(store, batch, "r", 1, tables.product())  # redelivered as another batch
    after = state(store)
    assert before[:3] == after[:3]

    path, schema = staged(tables, 1)
    stream = flows.file_stream(spark, path, schema)
    runs.process_run(store, stream, "later", tables.product())
    with pytest.raises(RuntimeError):
        runs.process_run(store, stream, "later", tables.product())


def test_empty_run_completes(spark, tables):
    path = scratch(spark, "none")
    tables.record().where("false").write.parquet(path)
    store = store_for(tables)
    report = runs.process_run(store, flows.file_stream(spark, path, tables.record().schema), "r", tables.product())
    assert [tuple(r) for r in report.collect()] == [(0, 0, 0, S.RUN_STATE["COMPLETED"])]


def test_lost_record_and_failure_show(spark, tables, monkeypatch):
    path = scratch(spark, "few")
    sent = tables.record().where("request_id < 20")
    sent.where("request_id <> 7").write.parquet(path)
    stream = flows.file_stream(spark, path, sent.schema)
    store = store_for(tables)
    report = runs.process_run(store, stream, "lost", tables.product(), published=sent).first()
    assert report["nbr_published"] == report["nbr_processed"] + report["nbr_processed_with_error"] + 1
    assert report["run_state"] == runs.run_state(store, "lost").first()["run_state"] == S.RUN_STATE["EXECUTING"]

    def broken(*_args, **_more):
        raise ValueError("no such batch")

    monkeypatch.setattr(runs, "handle_batch", broken)
    with pytest.raises(Exception):
        runs.process_run(store, stream, "broken", tables.product())
    last = runs.run_state(store, "broken").first()
    assert last["run_state"] == S.RUN_STATE["EXCEPTION"] and "no such batch" in last["message"]


def test_stop_and_restart_lose_nothing(spark, tables):
    path, schema = staged(tables, 2)
    out = scratch(spark, "restart")
    got = []

    def run():
        flows.run_batches(flows.file_stream(spark, path, schema, max_files=1), 
                          lambda df, n: got.append((n, df.count())), "x", checkpoint=out)

    run()
    run()  # nothing new
    extra = tables.record().limit(7)
    extra.coalesce(1).write.mode("append").parquet(path)
    run()
    assert sum(n for _, n in got) == tables.record().count() + 7
    assert [b for b, _ in got] == list(range(len(got)))


def test_stream_dedup_drops_repeats_and_processed(spark):
    path = scratch(spark, "dups")
    at = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([(1, at), (1, at), (2, at), (3, at)], "request_id long, ts timestamp").coalesce(1).write.parquet(path)
    stream = flows.file_stream(spark, path, spark.read.parquet(path).schema)
    done = spark.createDataFrame([(3,)], "request_id long")
    seen = []
    flows.run_batches(flows.dedup_stream(stream, done), lambda df, n: seen.extend(r.request_id for r in df.collect()), "d")
    assert sorted(seen) == [1, 2]


def test_upper_on_text(spark):
    path = scratch(spark, "hello")
    spark.range(100).select(F.format_string("Hello: %d", "id").alias("value")).write.parquet(path)
    stream = flows.file_stream(spark, path, spark.read.parquet(path).schema)
    out = flows.run_to_files(flows.stream_upper(flows.text_values(stream)), "hello")
    assert {r.value for r in out.collect()} == {f"HELLO: {i}" for i in range(100)}


def test_keyed_state_over_several_batches(spark):
    path = scratch(spark, "keys")
    for i in range(3):
        spark.createDataFrame([("a", i + 1), ("b", 10)][: 1 + i % 2], "k string, v long").coalesce(1).write.mode(
            "append").parquet(path)
    stream = flows.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    state_rows = flows.keyed_state_update(stream, "k", "v").collect()
    assert {(r.k, r.total, r.changes) for r in state_rows} == {("a", 6, 3), ("b", 10, 1)}


def test_dead_letters_keep_the_good_ones(spark):
    ok = '{"requestId":%d,"personId":1,"productId":1,"qty":%s,"operation":10,"result":10,"extra":true}'
    values = [ok % (1, "2"), '{"requestId":2', ok % (3, '"x"'), ok % (4, "9"), ok % (5, "1")]
    raw = spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(values)],
                                "topic string, partition_id int, offset_id long, msg_value string")
    split = {r.offset_id: (r.target_topic, r.error) for r in
             records.dead_letter_split(raw, [rules.num_max("qty", 4)]).collect()}
    assert split == {0: ("t", None), 1: ("t-dlt", "malformed"), 2: ("t-dlt", "malformed"),
                     3: ("t-dlt", "qty:num_max"), 4: ("t", None)}


def test_uncommitted_batch_is_invisible_and_publishing_twice_is_once(spark, tables):
    store = SnapshotStore(spark, scratch(spark, "publish"))
    n = flows.publish_requests(store, tables.request(), PARTITIONS, "b1", "replay")
    assert flows.publish_requests(store, tables.request(), PARTITIONS, "b1", "replay") == n == store.load_log("records").count()
    store.stage_part("records", store.load_log("records").withColumn("batch_id", F.lit("b2")))
    assert [r.batch_id for r in store.load_log("records").select("batch_id").distinct().collect()] == ["b1"]
    assert store.load_log("records").where(records.header("replay-id") == "replay").count() == n


def test_lag_of_a_running_query_is_written_down(spark):
    """Three files, one a batch: the log holds one row a batch, and other queries leave none."""
    import time

    from orderweave.streaming.lag_log import LagLog, offset_rows

    source, log = scratch(spark, "lag-source"), LagLog(spark, scratch(spark, "lag-log"), "group_under_test")
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(source)
    spark.streams.addListener(log)
    try:
        for name in ("group_under_test", "another"):
            stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
            stream.writeStream.queryName(name).format("noop").trigger(availableNow=True).option(
                "checkpointLocation", scratch(spark, "lag-check")).start().awaitTermination()
        until = time.time() + 30
        while time.time() < until:  # events arrive a little behind the query
            try:
                if log.history().count() >= 3:
                    break
            except Exception:  # nothing written yet
                pass
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(log)
    rows = log.history().collect()
    assert {r.group_id for r in rows} == {"group_under_test"} and {r.batch_id for r in rows} == {0, 1, 2}
    last = log.latest().collect()
    assert len(last) == 1 and last[0].lag == 0 and last[0].committed_offset == max(r.committed_offset for r in rows)
    topics = {"sources": [{"description": "d", "endOffset": {"t": {"0": 5, "1": 7}}, "latestOffset": {"t": {"0": 9, "1": 7}}},
                          {"description": "none yet", "endOffset": None, "latestOffset": None}]}
    assert [(r["partition_id"], r["lag"]) for r in offset_rows(topics, "g")] == [(0, 4), (1, 0)]
