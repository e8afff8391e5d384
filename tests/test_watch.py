"""Stall and contract checks on streams: restart, late counts, replayed batches."""

from __future__ import annotations

import json
from datetime import date

from orderweave.functions import rules
from orderweave.schemas import CREDIT, PENDING
from orderweave.session import scratch
from orderweave.sources.snapshots import SnapshotStore
from orderweave.streaming import flows, watch


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_stalls_go_on_after_a_stop(spark):
    place, schema = scratch(spark, "stall"), "k string, day date, pending long"

    def run(*rows):
        put(spark, f"{place}/in", [(k, date(2024, 1, d) if d else None, n) for k, d, n in rows], schema)
        stream = flows.file_stream(spark, f"{place}/in", spark.read.parquet(f"{place}/in").schema, 1)
        found = watch.stall_stream(stream, "k", "day", "pending", place)
        return {r.k: (r.day.day, r.pending, r.previous, r.stalls, r.late) for r in found.collect()}

    assert run(("a", 2, 5), ("a", 1, 5), ("b", 1, 0), ("b", None, 9)) == {"a": (2, 5, 5, 1, 0), "b": (1, 0, None, 0, 0)}
    # zero is no stall, fewer is none, and a count that comes too late changes nothing
    assert run(("a", 3, 4), ("b", 2, 0), ("a", 2, 99), ("c", 1, 1)) == {
        "a": (3, 4, 5, 1, 1), "b": (2, 0, 0, 0, 0), "c": (1, 1, None, 0, 0)}
    assert run(("a", 4, 4), ("c", 3, 7)) == {"a": (4, 4, 4, 2, 1), "b": (2, 0, 0, 0, 0), "c": (3, 7, 1, 1, 0)}


def test_broken_records_go_to_the_dead_letters_of_their_batch(spark):
    store = SnapshotStore(spark, scratch(spark, "contract"))
    schema = "topic string, partition_id int, offset_id long, msg_value string"
    contract = [rules.num_max("qty", 4), rules.positive("qty")]

    def message(qty):
        return json.dumps({"requestId": 1, "personId": 1, "productId": 1, "qty": qty, "operation": CREDIT, "result": PENDING})

    def run(*values):
        put(spark, f"{store.root}/in", [("t", 0, offset, v) for offset, v in values], schema)
        stream = flows.file_stream(spark, f"{store.root}/in", spark.read.parquet(f"{store.root}/in").schema, 1)
        accepted, dead = watch.contract_stream(store, stream, contract, "c")
        return ({r.record_id for r in accepted.collect()},
                {r.record_id: (r.target_topic, r.violations) for r in dead.collect()})

    good, dead = run((1, message(3)), (2, message(5)), (3, "{"), (4, None))
    assert good == {"t/0/1"}
    assert {k: v[1] for k, v in dead.items()} == {
        "t/0/2": "qty:num_max", "t/0/3": "msg_value:schema", "t/0/4": "msg_value:schema"}
    assert len({v[0] for v in dead.values()}) == 1 and all(v[0] != "t" for v in dead.values())
    good, dead = run((5, message(0)), (6, message(4)))
    assert good == {"t/0/1", "t/0/6"} and dead["t/0/5"][1] == "qty:positive" and len(dead) == 4
    # both parts of a batch were published by one commit, which a replay would find
    assert store.committed("c/0") and store.committed("c/1")
    assert store.added_by("c/1", "accepted").count() == store.added_by("c/1", "dead_letters").count() == 1
