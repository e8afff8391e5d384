"""Rows that must not pass, be lost or stop a job."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from orderweave.functions import messages, numbers
from orderweave.operators import corroborate, mutate, records, views
from orderweave.session import scratch
from orderweave.streaming import flows

GOOD = '{"requestId":1,"personId":2,"productId":3,"qty":4,"operation":10,"result":10}'


@pytest.mark.parametrize("text", [
    None, "", "{}", "null", "{", GOOD.replace('"operation":10', '"operation":55'), GOOD.replace('"result":10', '"result":77'),
    GOOD.replace('"qty":4', '"qty":99999999999'), GOOD.replace('"qty":4', '"qty":"x"')])
def test_messages_that_cannot_be_bound(spark, text):
    df = spark.createDataFrame([("t", 0, 1, text), ("t", 0, 2, GOOD)],
                               "topic string, partition_id int, offset_id long, msg_value string")
    got = {r["offset_id"]: r for r in records.dead_letter_split(df).collect()}
    assert (got[1]["error"], got[1]["target_topic"], got[1]["request_id"], got[1]["operation"]) == (
        "malformed", "t-dlt", None, None)
    assert (got[2]["error"], got[2]["target_topic"], got[2]["request_id"]) == (None, "t", 1)
    assert got[1][messages.CORRUPT] == (text or "")


def test_cost_beyond_the_type(spark):
    df = spark.createDataFrame([("12.50", 4), ("99999999.99", 99999999999), (None, 1), ("1.00", None)],
                               "p string, q long").select(F.col("p").cast("decimal(10,2)").alias("p"), "q")
    got = [r[0] for r in df.select(numbers.request_cost(F.col("p"), F.col("q"))).collect()]
    assert [None if x is None else str(x) for x in got] == ["50.00", numbers.LARGEST_COST, None, None]


def test_mix_has_fixed_values_and_keeps_high_bits(spark):
    ids = [0, 1, 5, 4294967295, 4294967301, -7, 2**62 + 3]
    df = spark.createDataFrame([(i,) for i in ids], "id long").withColumn("m", numbers.mix_id32(F.col("id")))
    rows = df.withColumn("u", numbers.unmix_id32(F.col("m"))).collect()
    assert [r["u"] for r in rows] == ids
    assert len({r["m"] for r in rows}) == len(ids)
    assert all(r["m"] >> 32 == r["id"] >> 32 for r in rows)


def test_two_credits_do_not_oversell(spark):
    inventory = spark.createDataFrame([(1, 1, 5)], "inventory_id long, product_id long, qty long")
    credit = spark.createDataFrame([(1, 10, 4), (1, 11, 4)], "inventory_id long, request_id long, credit_qty long")
    got = {r["request_id"]: (r["qty_after"], r["result"]) for r in mutate.conditional_credit(inventory, credit).collect()}
    assert got == {10: (1, 30), 11: (5, 10)}


def test_every_credit_of_a_row_is_answered(spark):
    """Several credits of one row, a hot row cut into many chunks, against the plain serial fold."""
    import random

    from orderweave.operators import allocate

    rng = random.Random(5)
    stock = {1: 900, 2: 40, 3: 0, 4: 7}
    credits = [(1 if rng.random() < 0.7 else rng.randint(2, 5), n, rng.randint(1, 9)) for n in rng.sample(range(9000), 400)]
    left, want = dict(stock), {}
    for key, n, qty in sorted(credits, key=lambda c: c[1]):
        if key in left:
            ok = left[key] >= qty
            want[n] = (key, left[key], left[key] - qty * ok, 30 if ok else 20)
            left[key] -= qty * ok
    inventory = spark.createDataFrame([(k, k, q) for k, q in stock.items()], "inventory_id long, product_id long, qty long")
    credit = spark.createDataFrame(credits, "inventory_id long, request_id long, credit_qty long")
    got = allocate.credit_in_order(inventory, credit, chunk_rows=20).collect()
    assert len(got) == len(want)
    assert {r["request_id"]: (r["inventory_id"], r["qty_before"], r["qty_after"], r["result"]) for r in got} == want
    assert {30, 20} == {r["result"] for r in got if r["inventory_id"] == 1}


def test_one_of_two_changes_is_applied(spark):
    table = spark.createDataFrame([(1, 7, 3), (2, 8, 1)], "id long, v long, version long")
    changes = spark.createDataFrame([(1, 3, 100, 2), (1, 3, 200, 1), (1, 2, 5, 0), (2, 9, 1, 1), (3, 0, 1, 1)],
                                    "id long, expected_version long, v long, n int")
    got = sorted(tuple(r) for r in mutate.optimistic_update(table, changes, "id", "v", order="n").collect())
    assert got == [(1, "applied", 200, 4), (1, "stale", 7, 3), (1, "stale", 7, 3), (2, "stale", 8, 1),
                   (3, "missing", None, None)]


def test_unique_columns(spark):
    schema = "id long, seq long, first string, last string"
    existing = spark.createDataFrame([(1, 0, "a", "b")], schema)
    new = spark.createDataFrame(
        [(2, 1, "a", "b"), (3, 2, "c", "d"), (4, 3, "c", "d"), (5, 4, None, "d"), (6, 5, None, "d"), (3, 6, "e", "f")], schema)
    got = {(r["id"], r["seq"]): r["status"] for r in mutate.insert_with_constraints(
        new, existing, "id", "seq", [], {}, unique=[("first", "last")]).collect()}
    assert got == {(2, 1): "duplicate_first_last", (3, 2): "accepted", (4, 3): "duplicate_in_batch", (5, 4): "accepted",
                   (6, 5): "accepted", (3, 6): "duplicate_in_batch"}


def test_moved_product_without_snapshot(spark):
    executed = spark.createDataFrame([(9, 10, 2, 30)], "product_id long, operation int, qty long, result int")
    none = spark.createDataFrame([], "product_id long, qty long")
    got = corroborate.movement_reconcile(executed, none, none).collect()
    assert [tuple(r) for r in got] == [(9, -2, None)]


def test_fingerprint_tells_rows_apart(spark):
    def sums(*rows):
        df = spark.createDataFrame([(1, *r) for r in rows], "id long, a string, b string")
        return [r["checksum"] for r in corroborate.state_checksum(df, "id", ["a", "b"], 1).collect()]

    seen = [sums(r) for r in (("a|b", "c"), ("a", "b|c"), (None, "c"), ("\\N", "c"), ("-", "c"), ("", "c"), ("1:-", "c"))]
    assert len({tuple(s) for s in seen}) == len(seen)
    many = spark.range(200_000).select(F.lit(1).alias("id"), F.col("id").cast("string").alias("a"))
    assert int(corroborate.state_checksum(many, "id", ["a"], 1).first()["checksum"]) > 2**63


def test_late_first_delivery_is_kept(spark):
    path = scratch(spark, "late")
    at = datetime.datetime(2024, 1, 1)
    for n, rows in enumerate([[(1, 12), (2, 13)], [(3, 9), (1, 12)]]):
        spark.createDataFrame([(i, at + datetime.timedelta(hours=h)) for i, h in rows], "request_id long, ts timestamp").coalesce(
            1).write.mode("append").parquet(path)
    stream = flows.file_stream(spark, path, spark.read.parquet(path).schema, 1)
    seen = []
    flows.run_batches(flows.dedup_stream(stream, spark.createDataFrame([], "request_id long")),
                      lambda df, n: seen.extend(r.request_id for r in df.collect()), "late")
    assert sorted(seen) == [1, 2, 3]


def test_pages_by_last_row(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("o"))
    for down in (False, True):
        want = [(r["o"], r["id"]) for r in df.orderBy(F.col("o").desc() if down else F.col("o"), "id").collect()]
        got, last = [], None
        while rows := views.page_after(df, "o", "id", 9, last, down).collect():
            got += [(r["o"], r["id"]) for r in rows]
            last = got[-1]
        assert got == want


def test_running_total(spark):
    from orderweave.operators.ordering import running_total

    rows = [(i % 3 if i % 3 else None, 10**15 * (i % 50), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g long, o long, v long")
    got = running_total(df, ["o"], "t", by=["g"], value=F.col("v")).collect()
    for g in (None, 1, 2):
        mine = sorted((r for r in got if r["g"] == g), key=lambda r: (r["o"], r["t"]))
        total = 0
        for r in mine:
            assert r["t"] == total
            total += r["v"]
    assert running_total(df.limit(0), ["o"], "t").collect() == []
