"""Consumer lag, alerts, topic summaries and the scaling advice."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweave.functions.numbers import clamped_lag
from orderweave.operators.filters import consumer_groups_only
from orderweave.session import small_side

PLACE = ["topic", "partition_id"]
NO_THRESHOLD = 2**63 - 1


def offset_join(committed: DataFrame, end: DataFrame) -> DataFrame:
    """Committed offsets with the log end; a partition without an end offset counts as fully read.

    Few partitions carry very many groups, so a shuffle on the partition would be badly skewed: the end offsets
    (one row per topic partition) are broadcast after a size check.
    """
    return committed.join(small_side(end, "log-end"), PLACE, "left").select(
        "group_id", *PLACE, "committed_offset",
        F.coalesce("end_offset", "committed_offset").alias("end_offset"),
    )


def consumer_lag(committed: DataFrame, end: DataFrame) -> DataFrame:
    return offset_join(committed, end).withColumn("lag", clamped_lag(F.col("end_offset"), F.col("committed_offset")))


def lag_alerts(lag: DataFrame, threshold: DataFrame) -> DataFrame:
    """Rows with a lag strictly above the threshold of their group; without one there is no alert."""
    limit = F.coalesce("threshold", F.lit(NO_THRESHOLD))
    return lag.join(threshold, "group_id", "left").where(F.col("lag") > limit).select(
        "group_id", *PLACE, "lag"
    )


def group_total_lag(groups: DataFrame, committed: DataFrame, end: DataFrame) -> DataFrame:
    """Total lag per consumer group; a group without offsets is UNKNOWN.

    Without an end offset the difference is null, which ``greatest`` turns into 0: such a partition adds nothing.
    """
    known = committed.join(small_side(end, "log-end"), PLACE, "left").groupBy("group_id").agg(
        F.sum(clamped_lag(F.col("end_offset"), F.col("committed_offset"))).alias("__lag")
    )
    return consumer_groups_only(groups).join(known.withColumn("__seen", F.lit(True)), "group_id", "left").select(
        "group_id",
        F.coalesce("__lag", F.lit(0)).cast("long").alias("total_lag"),
        F.when(F.col("__seen"), "ACTIVE").otherwise("UNKNOWN").alias("status"),
    )


def topic_summary(records: DataFrame) -> DataFrame:
    """Partitions, records and end offset per topic, from per-partition partial results."""
    per_partition = records.groupBy(*PLACE).agg(F.count("*").alias("n"), F.max("offset_id").alias("last"))
    return per_partition.groupBy("topic").agg(
        F.count("*").alias("partitions"), F.sum("n").alias("records"), (F.max("last") + 1).alias("end_offset")
    )


def scale_advice(total_lag: DataFrame, per_replica: int = 1000, low: int = 1, high: int = 10) -> DataFrame:
    """Replicas per group: total lag over ``per_replica``, rounded up, kept between ``low`` and ``high``."""
    wanted = F.ceil(F.col("total_lag") / F.lit(per_replica))
    return total_lag.select(
        "group_id", "total_lag", F.greatest(F.lit(low), F.least(F.lit(high), wanted)).cast("long").alias("replicas")
    )


def progress_lag(progress: Mapping, group_id: str) -> list[dict]:
    """Lag rows of a running query, read from one ``StreamingQueryProgress`` as JSON.

    Kafka sources report their offsets as ``{topic: {partition: offset}}``: the end of the last batch is what has
    been processed, and ``latestOffset`` is the log end. The rows are as few as the topic partitions.
    """
    rows = []
    for source in progress["sources"]:
        done, end = (json.loads(source[k]) if isinstance(source[k], str) else source[k]
                     for k in ("endOffset", "latestOffset"))
        for topic, parts in done.items():
            for part, committed in parts.items():
                last = end.get(topic, {}).get(part, committed)
                rows.append({"group_id": group_id, "topic": topic, "partition_id": int(part),
                             "committed_offset": committed, "end_offset": last, "lag": max(last - committed, 0)})
    return rows
