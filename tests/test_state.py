"""State per key and bounded dedup: stop and restart, late deliveries, repeats after the state has gone."""

from __future__ import annotations

import datetime
import time
from collections import Counter

from orderweave.session import scratch
from orderweave.sources.snapshots import SnapshotStore
from orderweave.streaming import flows, state


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_state_goes_on_after_a_stop(spark):
    place, schema = scratch(spark, "state"), "k string, n long, t string"

    def last_words(held, rows):
        """Not a sum: the text with the highest number, and how many rows the state has seen."""
        best = max([(int(n), t) for n, t in zip(rows["n"], rows["t"])] + [tuple(held[:2])])
        return (*best, held[2] + len(rows))

    batches = [[("a", 1, "x"), ("b", 5, "y")], [("a", 3, "z"), ("c", 1, "w")], [("b", 2, "late"), ("a", 2, "q"), ("a", 9, "end")]]

    def run():
        stream = flows.file_stream(spark, f"{place}/in", spark.read.parquet(f"{place}/in").schema, 1)
        found = state.mutate_state(stream, "k", "n long, t string, writes long", lambda key: (-1, "new " + key, 0), last_words, place)
        return {r.k: (r.n, r.t, r.writes) for r in found.collect()}

    put(spark, f"{place}/in", batches[0], schema)
    assert run() == {"a": (1, "x", 1), "b": (5, "y", 1)}
    for rows in batches[1:]:
        put(spark, f"{place}/in", rows, schema)
    want = {"a": (9, "end", 4), "b": (5, "y", 2), "c": (1, "w", 1)}
    assert run() == want
    assert run() == want  # nothing new


def test_dedup_with_small_state(spark):
    store, schema = SnapshotStore(spark, scratch(spark, "dedup")), "request_id long, ts timestamp"
    at = datetime.datetime(2024, 1, 1)

    def deliver(*rows):
        put(spark, f"{store.root}/in", [(i, at + datetime.timedelta(hours=h)) for i, h in rows], schema)
        stream = flows.file_stream(spark, f"{store.root}/in", spark.read.parquet(f"{store.root}/in").schema, 1)
        found = state.dedup_bounded(store, stream, "d", "1 second")
        time.sleep(1.2)
        return Counter(r.request_id for r in found.collect())

    assert deliver((1, 12), (2, 13), (1, 14)) == {1: 1, 2: 1}
    assert deliver((3, 9), (1, 12)) == {1: 1, 2: 1, 3: 1}  # 3 is late by its own time
    assert deliver((4, 1)) == {1: 1, 2: 1, 3: 1, 4: 1}
    # the state of 1 has gone by now
    assert deliver((1, 20), (5, 1), (5, 2)) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1}
    rows = spark.read.format("statestore").load(f"{store.root}/streams/d").count()
    assert rows <= 3  # of five ids
    # a batch that was committed is skipped
    assert store.committed("d/0") and store.load_log("processed").count() == 5
