"""A whole run: read records, set aside the broken ones, drop repeats, allocate, keep the new state."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweave.functions.rules import Rule
from orderweave.operators.allocate import CHUNK_ROWS, allocate_requests, next_inventory, next_person
from orderweave.operators.corroborate import compact_latest
from orderweave.operators.counts import with_run_state
from orderweave.operators.records import dead_letter_split, dedup_requests, unprocessed
from orderweave.schemas import BACK_ORDER, REQUEST, RUN_STATE
from orderweave.session import materialize
from orderweave.sources.snapshots import SnapshotStore
from orderweave.streaming.flows import run_batches

CONTROL = "run_id string, batch_id long, topic string, partition_id int, n long, n_failed long, max_offset long"
DELIVERED = "run_id string, request_id long, n long"
OUTCOME_IDS = "request_id long, run_id string, result int"
#: What the dead-letter log keeps of a record, whatever else the source delivers; what a source lacks is null.
DEAD_LETTER = {
    "topic": "string", "partition_id": "int", "offset_id": "long", "msg_key": "string", "msg_value": "string",
    "headers": "array<struct<key:string,value:binary>>", "record_id": "string", "error": "string", "target_topic": "string",
}
STATE = "run_id string, version long, run_state int, message string"


def open_store(store: SnapshotStore, inventory: DataFrame, person: DataFrame) -> SnapshotStore:
    """Put the opening balances in place; doing it twice changes nothing."""
    store.commit("open", tables={"inventory": inventory, "person": person})
    return store


def _done(store: SnapshotStore, run_id: str, asked: DataFrame) -> DataFrame:
    """Of the ids in ``asked``: those with any outcome in this run or a final one in an earlier run.

    Only ids, run and result of the history are read, and they are met with ``asked`` first: where that is small, as in a
    micro-batch, Spark sends it to the history and shuffles nothing of the latter.
    """
    outcomes = store.load_log("outcome", lambda: store.spark.createDataFrame([], OUTCOME_IDS))
    return (
        outcomes.where((F.col("run_id") == run_id) | (F.col("result") != BACK_ORDER)).select("request_id")
        .join(asked.select("request_id"), "request_id", "left_semi").distinct()
    )


def _note_state(store: SnapshotStore, run_id: str, key: str, state: str, message: str | None = None) -> None:
    row = [(run_id, store.version() + 1, RUN_STATE[state], message)]
    store.commit(f"{run_id}/{key}", added={"run_state": store.spark.createDataFrame(row, STATE)})


def run_state(store: SnapshotStore, run_id: str) -> DataFrame:
    """The last recorded state of a run, with the message of a failure."""
    states = store.load_log("run_state", lambda: store.spark.createDataFrame([], STATE), run_id=run_id)
    return compact_latest(states.where(F.col("run_id") == run_id), "run_id", "version")


def _report(store: SnapshotStore, run_id: str, published: DataFrame | None) -> DataFrame:
    """Published, processed and failed records, each counted at a place of its own: the publication (or what the stream
    delivered), the deliveries whose request has an outcome, and the dead letters."""
    spark, of_run, none = store.spark, F.col("run_id") == run_id, F.lit(0).cast("long")
    control = store.load_log("control", lambda: spark.createDataFrame([], CONTROL), run_id=run_id).where(of_run)
    delivered = store.load_log("delivered", lambda: spark.createDataFrame([], DELIVERED), run_id=run_id).where(of_run)
    handled = delivered.join(_done(store, run_id, delivered), "request_id", "left_semi")
    sent = control.select("n") if published is None else published.agg(F.count("*").alias("n"))
    marks = (
        sent.select(F.col("n").alias("sent"), none.alias("ok"), none.alias("bad"))
        .unionByName(handled.select(none.alias("sent"), F.col("n").alias("ok"), none.alias("bad")))
        .unionByName(control.select(none.alias("sent"), none.alias("ok"), F.col("n_failed").alias("bad")))
    )
    names = {"nbr_published": "sent", "nbr_processed": "ok", "nbr_processed_with_error": "bad"}
    return with_run_state(marks.agg(*[F.coalesce(F.sum(c), none).alias(name) for name, c in names.items()]))


def handle_batch(store: SnapshotStore, batch: DataFrame, run_id: str, batch_id: int, product: DataFrame,
                 rules: Sequence[Rule] = (), chunk_rows: int = CHUNK_ROWS) -> bool:
    """Apply one micro-batch. A batch that was committed before is skipped, so a replay has no effect.

    A request counts as processed once it has any outcome in this run or a final one in an earlier run: a
    back-order is tried again by the next run, not by a repeated delivery.
    """
    run_key = f"{run_id}/{batch_id}"
    if store.committed(run_key):
        return False
    # A micro-batch comes with a session that does not adapt its plans; the work goes on in the store's own.
    spark = store.spark
    split = materialize(dead_letter_split(batch, rules), "split", reader=spark)
    dead = split.where(F.col("error").isNotNull()).select(*[
        (F.col(c) if c in split.columns else F.lit(None)).cast(kind).alias(c) for c, kind in DEAD_LETTER.items()])
    control = split.groupBy("topic", "partition_id").agg(
        F.count("*").alias("n"), F.count("error").alias("n_failed"), F.max("offset_id").alias("max_offset")
    ).select(F.lit(run_id).alias("run_id"), F.lit(batch_id).cast("long").alias("batch_id"), "*")

    columns = REQUEST.fieldNames()
    sound = split.where(F.col("error").isNull())
    delivered = sound.groupBy("request_id").agg(F.count("*").alias("n")).select(F.lit(run_id).alias("run_id"), "*")
    first = materialize(dedup_requests(sound, order=("partition_id", "offset_id")).select(*columns), "first")
    fresh = materialize(unprocessed(first, _done(store, run_id, first)), "fresh")
    inventory, person = store.load("inventory"), store.load("person")
    decided = allocate_requests(fresh, inventory, product, person, chunk_rows)
    return store.commit(
        run_key,
        tables={"inventory": next_inventory(inventory, decided), "person": next_person(person, decided)},
        added={"outcome": decided.withColumn("run_id", F.lit(run_id)), "dead_letter": dead, "control": control,
               "delivered": delivered},
    )


def process_run(store: SnapshotStore, records: DataFrame, run_id: str, product: DataFrame,
                rules: Sequence[Rule] = (), chunk_rows: int = CHUNK_ROWS, published: DataFrame | None = None) -> DataFrame:
    """Process all records once and report the run: counts and final state.

    ``published`` has one row per record sent; a record that never came through leaves the run EXECUTING. A failure is
    recorded with its message and raised. A run id that has finished is refused. The streaming checkpoint lies beside
    the store, so an interrupted run goes on with the batch it was in; its commit key keeps that batch from counting
    twice.
    """
    if store.committed(f"{run_id}/closed"):
        raise RuntimeError(f"run {run_id} is not ready: it has been closed")

    def handle(batch: DataFrame, batch_id: int) -> None:
        handle_batch(store, batch, run_id, batch_id, product, rules, chunk_rows)

    attempt = uuid.uuid4().hex
    _note_state(store, run_id, f"started/{attempt}", "EXECUTING")
    try:
        run_batches(records, handle, run_id, checkpoint=f"{store.root}/streams/{run_id}")
    except Exception as error:
        _note_state(store, run_id, f"failed/{attempt}", "EXCEPTION", str(error))
        raise
    report = materialize(_report(store, run_id, published), "report", reader=store.spark)
    final = report.select(F.lit(run_id).alias("run_id"), F.lit(store.version() + 1).cast("long").alias("version"),
                          F.col("run_state").cast("int").alias("run_state"), F.lit(None).cast("string").alias("message"))
    store.commit(f"{run_id}/closed", added={
        "run_log": report.select(F.lit(run_id).alias("run_id"), "*"), "run_state": final})
    return store.load_log("run_log", run_id=run_id).where(F.col("run_id") == run_id).drop("run_id")
