"""Joins of requests to their parents split a hot key; hot aggregations shrink before the shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderweave.operators import mutate, records, views
from orderweave.session import materialize

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def big_parents(spark):
    """The session as it is when parents are too large to broadcast, with thresholds in the size of the test."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(tables):
    """The requests many times over; half of them go to one product."""
    copies = tables.request().withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(199))))
    hot_half = F.pmod(F.xxhash64("request_id", "copy"), F.lit(2)) == 0
    rows = copies.select(
        (F.col("request_id") * 200 + F.col("copy")).alias("request_id"),
        F.pmod(F.xxhash64("copy", "request_id"), F.lit(150)).alias("person_id"),
        F.when(hot_half, 7).otherwise(F.pmod(F.xxhash64("copy"), F.lit(200))).alias("product_id"),
        "qty", "operation", "result",
    )
    return materialize(rows.repartition(8), "hot")


def final_plan(df):
    rows = df.collect()
    return len(rows), df._jdf.queryExecution().executedPlan().toString()


def test_hot_product_is_split_in_the_view(tables, big_parents):
    request = hot(tables)
    n, plan = final_plan(views.request_view(request, tables.person(), tables.product()))
    assert n == 200_000 and "skew=true" in plan


def test_hot_product_is_split_in_the_enrichment(tables, big_parents):
    request = hot(tables)
    n, plan = final_plan(views.enrich_requests(request, tables.inventory(), tables.product(), tables.person()))
    assert n == 200_000 and "skew=true" in plan


def test_a_repeated_key_and_a_hot_parent_are_split_on_insert(tables, big_parents):
    new = hot(tables).withColumn("seq", F.col("request_id"))
    again = F.pmod(F.xxhash64("seq"), F.lit(2)) == 0
    new = materialize(new.withColumn("request_id", F.when(again, 10**9).otherwise(F.col("seq") + 10**6)), "new")
    df = mutate.insert_with_constraints(
        new, tables.request(), "request_id", "seq", ["qty"], {"product_id": tables.product()})
    counts = {r.status: r["count"] for r in df.groupBy("status").count().collect()}
    copies = new.where(again).count()
    assert counts == {"accepted": 200_000 - copies + 1, "duplicate_in_batch": copies - 1}


def test_copies_of_one_record_combine_before_the_shuffle(spark, tables):
    copies = tables.record().withColumn("attempt", F.explode(F.sequence(F.lit(1), F.lit(50))))
    df = records.dedup_requests(copies)
    assert df.count() == tables.record().count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
