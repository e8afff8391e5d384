"""Streaming sources, sinks and the simple flows between them.

Every flow takes a streaming DataFrame, so the source may be a topic (``sources.topics.read_topic``) or a folder of
files. Flows run with ``availableNow``: they take what is there in rate-limited batches and stop.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderweave.functions.messages import CORRUPT, with_request
from orderweave.functions.text import upper_text
from orderweave.operators.corroborate import checkpoint_events, compact_latest
from orderweave.operators.filters import eligible_requests
from orderweave.operators.records import outgoing
from orderweave.session import scratch
from orderweave.sources.snapshots import SnapshotStore


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
                only: str | None = None) -> DataFrame:
    """Files of a folder as a stream, each read once, from the beginning."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if only is not None:
        reader = reader.option("pathGlobFilter", only)
    return reader.parquet(path)


def run_to_files(stream: DataFrame, label: str) -> DataFrame:
    """Run the stream to its end into a Parquet sink and return what the sink holds."""
    spark = stream.sparkSession
    path = scratch(spark, label)
    query = (
        stream.writeStream.format("parquet").option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], label: str, mode: str = "append",
                checkpoint: str | None = None) -> None:
    """Run the stream to its end through ``foreachBatch``; the same checkpoint continues where it stopped."""
    place = checkpoint or scratch(stream.sparkSession, label)
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(handle)
        .option("checkpointLocation", place).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def text_values(stream: DataFrame, column: str = "value") -> DataFrame:
    """Only the value, as text."""
    return stream.select(F.col(column).cast("string").alias("value"))


def stream_upper(values: DataFrame) -> DataFrame:
    """Uppercase every value: no state and no shuffle."""
    return values.select(upper_text(F.col("value")).alias("value"))


def stream_requests(records: DataFrame) -> DataFrame:
    """Readable requests of a record stream; broken ones go the way of the dead letters."""
    return with_request(records).where(F.col(CORRUPT).isNull()).select(
        "request_id", "person_id", "product_id", "qty", "operation", "result"
    )


def dedup_stream(requests: DataFrame, processed: DataFrame) -> DataFrame:
    """Each request once, however late its first delivery comes.

    A watermark would drop late first deliveries, so the state holds every id this query has seen; ids finished before it
    began come from ``processed``. Begin a new query from time to time to keep the state small.
    """
    return requests.dropDuplicates(["request_id"]).join(processed.select("request_id"), "request_id", "left_anti")


def publication(request: DataFrame, partitions: int, batch_id: str, replay_id: str | None = None,
                keyed: bool = True) -> DataFrame:
    """The records one publication adds to the log."""
    return outgoing(eligible_requests(request), partitions, batch_id, replay_id, keyed).select(
        "request_id", "msg_key", "msg_value", "partition_id", "headers", F.lit(batch_id).alias("batch_id"))


def publish_requests(store: SnapshotStore, request: DataFrame, partitions: int, batch_id: str,
                     replay_id: str | None = None, keyed: bool = True) -> int:
    """Publish all eligible requests or none: readers of the log see the batch once its commit record exists.

    Returns the number published, read from the written batch.
    """
    store.commit(f"publish/{batch_id}", added={"records": publication(request, partitions, batch_id, replay_id, keyed)})
    return store.added_by(f"publish/{batch_id}", "records").count()


def keyed_state_update(changes: DataFrame, key: str, value: str, label: str = "keyed-state") -> DataFrame:
    """Running total and number of changes per key, kept in Spark's state store; a key starts on first use.

    Changes are summed on the map side before they reach the state of their key, so a key that gets a third of all
    changes still sends one row per task. Each batch appends the keys it touched; the last row of a key is its
    state.
    """
    spark = changes.sparkSession
    path = scratch(spark, label)
    totals = changes.groupBy(key).agg(F.sum(value).alias("total"), F.count("*").alias("changes"))

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
            f"{path}/touched/batch={batch_id}")

    run_batches(totals, save, label, mode="update", checkpoint=f"{path}/checkpoint")
    touched = spark.read.parquet(f"{path}/touched")
    return compact_latest(touched.drop("batch"), key, "batch_id").drop("batch_id")


def progress_events(records: DataFrame, label: str = "progress") -> DataFrame:
    """Control rows of each batch: records and highest offset per partition."""
    spark = records.sparkSession
    path = scratch(spark, label)

    def save(batch: DataFrame, batch_id: int) -> None:
        checkpoint_events(batch, batch_id).write.mode("overwrite").parquet(f"{path}/control/batch={batch_id}")

    run_batches(records, save, label, checkpoint=f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/control").drop("batch")
