"""State per key in streams: read, change and write with a given function, and dedup whose state stays small.

Both resume from their checkpoint: what a stopped query had in its state is there when it goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from orderweave.operators.corroborate import compact_latest
from orderweave.session import materialize
from orderweave.sources.snapshots import SnapshotStore
from orderweave.streaming.flows import run_batches

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _state_in_rocks(spark: SparkSession) -> Iterator[None]:
    """`transformWithState` needs this state store; other queries of the session keep theirs."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def _processor(key: T.StructField, state: T.StructType, start: Callable[[Any], tuple],
               change: Callable[[tuple, pd.DataFrame], tuple]) -> StatefulProcessor:
    """Built here, so that tasks get it by value."""
    names = [key.name, *state.fieldNames()]

    class ReadChangeWrite(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.held = handle.getValueState("held", state)

        def handleInputRows(self, key, rows, timerValues):
            value = tuple(self.held.get()) if self.held.exists() else start(key[0])
            for some in rows:  # a key with very many rows comes in several frames
                value = change(value, some)
            self.held.update(tuple(value))
            yield pd.DataFrame([(key[0], *value)], columns=names)

        def close(self) -> None:
            pass

    return ReadChangeWrite()


def mutate_state(changes: DataFrame, key: str, state: str, start: Callable[[Any], tuple],
                 change: Callable[[tuple, pd.DataFrame], tuple], place: str) -> DataFrame:
    """The state of every key after all changes: read, changed and written back by one task at a time.

    ``start(key)`` gives the state of a key on first use, ``change(state, rows)`` the next one; ``state`` names its columns.
    Rows of a key come in frames of bounded size, in no promised order inside a micro-batch, so a change that depends on order
    has to find it in its rows. ``place`` holds checkpoint and results: calling again with the same place goes on where the
    last call stopped, and a batch that is done again overwrites its own results.
    """
    spark = changes.sparkSession
    fields = T.StructType.fromDDL(state)
    key_field = T.StructField(key, changes.schema[key].dataType)
    layout = T.StructType([key_field, *fields])

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
            f"{place}/touched/batch={batch_id}")

    with _state_in_rocks(spark):
        touched = changes.groupBy(key).transformWithStateInPandas(
            statefulProcessor=_processor(key_field, fields, start, change), outputStructType=layout,
            outputMode="Update", timeMode="None")
        run_batches(touched, save, "keyed-state", mode="update", checkpoint=f"{place}/checkpoint")
    stored = spark.read.schema(T.StructType([*layout, T.StructField("batch_id", T.LongType())])).parquet(f"{place}/touched/*")
    return compact_latest(stored, key, "batch_id").drop("batch_id")


def dedup_bounded(store: SnapshotStore, requests: DataFrame, name: str, keep: str = "1 hour",
                  key: str = "request_id") -> DataFrame:
    """Each request once, however often and however late it is delivered, with a state that does not grow for ever.

    The state holds a key for ``keep`` after its *arrival*, so no first delivery is too late for it, whatever times the
    requests carry. A repeat that comes after that is found in the store's log of processed keys: of each micro-batch only
    keys that are not there are committed, together with their entry in that log. The checkpoint lies in the store, and a
    batch that is replayed is skipped by its commit key.
    """
    columns = requests.columns
    arrived = requests.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", keep)

    def save(batch: DataFrame, batch_id: int) -> None:
        run_key = f"{name}/{batch_id}"
        if store.committed(run_key):
            return
        first = materialize(batch.select(*columns), "delivered", reader=store.spark)
        processed = store.load_log("processed", lambda: first.limit(0).select(key)).select(key)
        known = processed.join(first.select(key), key, "left_semi").distinct()
        fresh = materialize(first.join(known, key, "left_anti").select(*columns), "fresh")
        store.commit(run_key, added={"processed": fresh.select(key), "accepted": fresh})

    run_batches(arrived.dropDuplicatesWithinWatermark([key]), save, name, checkpoint=f"{store.root}/streams/{name}")
    return store.load_log("accepted", lambda: store.spark.createDataFrame([], requests.schema), run_id=name)
