"""Topic specifications and the source and sink options made from them.

The Kafka connector is not part of a plain PySpark install, so these options are only built here; the flows take
any source with the same columns, and tests feed them from files.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderweave.operators.filters import RESERVED_TOPICS

# Defaults of a topic and the names it may have.
DEFAULT_PARTITIONS = 8
DEFAULT_REPLICAS = 1
DEFAULT_RETRIES = 1
DEFAULT_RETRY_MS = 250
MAX_POLL_RECORDS = 10
TOPIC_NAME = re.compile(r"[a-zA-Z0-9._-]+")


@dataclass(frozen=True)
class TopicSpec:
    """One topic, its dead-letter topic (empty for none) and its delivery settings."""

    name: str
    dead_letter: str = ""
    partitions: int = DEFAULT_PARTITIONS
    replicas: int = DEFAULT_REPLICAS
    retry_attempts: int = DEFAULT_RETRIES
    retry_interval_ms: int = DEFAULT_RETRY_MS
    producer_options: Mapping[str, str] = field(default_factory=dict)
    consumer_options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.name.strip():
            raise ValueError("a topic needs a name")
        for name in filter(str.strip, (self.name, self.dead_letter)):
            if name.startswith(RESERVED_TOPICS):
                raise ValueError(f"{name} is reserved")
            if not TOPIC_NAME.fullmatch(name):
                raise ValueError(f"{name} is not a valid topic name")
        for setting in ("partitions", "replicas", "retry_attempts", "retry_interval_ms"):
            if getattr(self, setting) <= 0:
                raise ValueError(f"{setting} must be positive")


def source_options(spec: TopicSpec, servers: str, max_offsets: int | None = None) -> dict[str, str]:
    """Kafka source: from the earliest offset, committed records only, optionally rate limited."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": spec.name,
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
        "includeHeaders": "true",
        "failOnDataLoss": "true",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    options.update({f"kafka.{k}": str(v) for k, v in spec.consumer_options.items()})
    return options


def sink_options(spec: TopicSpec, servers: str) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "topic": spec.name, "kafka.acks": "all",
               "kafka.enable.idempotence": "true"}
    options.update({f"kafka.{k}": str(v) for k, v in spec.producer_options.items()})
    return options


def read_topic(spark: SparkSession, spec: TopicSpec, servers: str, max_offsets: int | None = None) -> DataFrame:
    """Streaming records of a topic in the stored-record columns. Needs the Kafka connector; not tested here."""
    raw = spark.readStream.format("kafka").options(**source_options(spec, servers, max_offsets)).load()
    return raw.select(
        "topic", F.col("partition").alias("partition_id"), F.col("offset").alias("offset_id"),
        F.col("key").cast("string").alias("msg_key"), F.col("value").cast("string").alias("msg_value"),
        "headers", F.col("timestamp").alias("ts"),
    )


def kafka_rows(outgoing: DataFrame) -> DataFrame:
    """Outgoing records in the columns the Kafka sink expects."""
    return outgoing.select(
        F.col("msg_key").alias("key"), F.col("msg_value").alias("value"), F.col("partition_id").alias("partition"),
        "headers",
    )


def replay_options(start: Mapping[str, Mapping[int, int]]) -> dict[str, str]:
    """Batch read from chosen offsets: ``{topic: {partition: offset}}``."""
    return {"startingOffsets": json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in start.items()}),
            "endingOffsets": "latest"}


def write_topic(outgoing: DataFrame, spec: TopicSpec, servers: str) -> None:
    """Send a batch of outgoing records. Needs the Kafka connector; not tested here.

    The sink is at least once: readers that must see a publication whole use the snapshot store instead.
    """
    kafka_rows(outgoing).write.format("kafka").options(**sink_options(spec, servers)).save()


def stream_to_topic(values: DataFrame, spec: TopicSpec, servers: str, checkpoint: str):
    """Start writing a stream of text values to a topic. Needs the Kafka connector; not tested here."""
    return (
        values.select("value").writeStream.format("kafka").options(**sink_options(spec, servers))
        .option("checkpointLocation", checkpoint).start()
    )
