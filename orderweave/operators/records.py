"""Work on stored records: routing, tagging, deduplication, dead letters, replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweave.functions.messages import CORRUPT, request_to_json, with_request
from orderweave.functions.numbers import clamped_seek
from orderweave.functions.rules import Rule
from orderweave.session import small_side

# Header names and the suffix of a dead-letter topic.
HEADER_BATCH = "batch-id"
HEADER_REPLAY = "replay-id"
DLT_SUFFIX = "-dlt"


def route_by_key(request: DataFrame, partitions: int, keyed: bool = True) -> DataFrame:
    """Message key and target partition.

    Keyed: the product id, and the same key always goes to the same partition. Not keyed: a null key, spread
    evenly. The partition is a column for the sink, so nothing is shuffled here and a hot key costs no more than
    any other row.
    """
    if keyed:
        return request.withColumn("msg_key", F.col("product_id").cast("string")).withColumn(
            "partition_id", F.pmod("product_id", F.lit(partitions)).cast("int")
        )
    return request.withColumn("msg_key", F.lit(None).cast("string")).withColumn(
        "partition_id", F.pmod("request_id", F.lit(partitions)).cast("int")
    )


def tag_batch(df: DataFrame, batch_id: str, replay_id: str | None = None) -> DataFrame:
    """Attach Kafka-shaped headers: one batch id for all rows, a replay id only when replay is on."""
    pairs = [(HEADER_BATCH, batch_id)] + ([(HEADER_REPLAY, replay_id)] if replay_id is not None else [])
    headers = F.array(*[
        F.struct(F.lit(k).alias("key"), F.lit(v).cast("binary").alias("value")) for k, v in pairs
    ])
    return df.withColumn("headers", headers)


def header(name: str) -> Column:
    """Text of the last header with that name; null when there is none."""
    found = F.filter("headers", lambda h: h["key"] == name)
    return F.try_element_at(found, F.lit(-1))["value"].cast("string")


def outgoing(request: DataFrame, partitions: int, batch_id: str, replay_id: str | None = None,
             keyed: bool = True) -> DataFrame:
    """Requests as records ready for a sink: key, value, partition and headers."""
    routed = route_by_key(request, partitions, keyed)
    return tag_batch(routed.withColumn("msg_value", request_to_json()), batch_id, replay_id)


def dedup_requests(delivery: DataFrame, key: str = "request_id",
                   order: Sequence[str] = ("partition_id", "offset_id", "attempt")) -> DataFrame:
    """The first delivery of each request.

    ``min_by`` is combined on the map side, so any number of copies of one request shrinks to one row per task
    before the shuffle.
    """
    row = F.struct(*[F.col(c) for c in delivery.columns])
    first = delivery.groupBy(key).agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("__row"))
    return first.select("__row.*")


def unprocessed(delivery: DataFrame, processed: DataFrame, key: str = "request_id") -> DataFrame:
    """Deliveries whose key is not among the processed ids."""
    return delivery.join(processed.select(key), key, "left_anti")


def record_id() -> Column:
    """Where a record is stored, as text; it exists even when the message cannot be read."""
    return F.concat_ws("/", "topic", "partition_id", "offset_id")


def dead_letter_split(records: DataFrame, rules: Sequence[Rule] = ()) -> DataFrame:
    """Every record parsed, with ``error`` (null when fine) and the topic it goes on to.

    A broken message and a broken rule are facts about the row, so trying again cannot help: the row is marked
    once and nothing is thrown. Split the result on ``error``.
    """
    parsed = with_request(records.withColumn("record_id", record_id()), "msg_value")
    error = F.lit(None).cast("string")
    for rule in reversed(rules):
        error = F.when(F.coalesce(rule.broken, F.lit(False)), F.lit(f"{rule.field}:{rule.name}")).otherwise(error)
    error = F.when(F.col(CORRUPT).isNotNull(), "malformed").otherwise(error)
    target = F.when(F.col("error").isNotNull(), F.concat("topic", F.lit(DLT_SUFFIX))).otherwise(F.col("topic"))
    return parsed.withColumn("error", error).withColumn("target_topic", target)


def log_end(records: DataFrame) -> DataFrame:
    """Offset behind the last record of each partition."""
    return records.groupBy("topic", "partition_id").agg((F.max("offset_id") + 1).alias("end_offset"))


def clamped_start(requested: DataFrame, end: DataFrame) -> DataFrame:
    """The offsets a group is really moved to: never behind the log end. One row per topic partition."""
    return requested.join(end, ["topic", "partition_id"], "left").select(
        "topic", "partition_id", clamped_seek(F.col("requested_offset"), F.col("end_offset")).alias("start_offset")
    )


def replay_from_offsets(records: DataFrame, start: DataFrame) -> DataFrame:
    """Records from ``start_offset`` on, per partition.

    ``start`` has one row per topic partition, far below the broadcast bound, which is checked. The eight or so
    partition keys would make a shuffle join badly skewed.
    """
    return records.join(small_side(start, "start"), ["topic", "partition_id"]).where(
        F.col("offset_id") >= F.col("start_offset")
    )
