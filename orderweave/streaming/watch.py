"""Checks on running streams: pending counts that do not fall, and records that break their contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweave.functions.messages import CORRUPT
from orderweave.functions.rules import Rule
from orderweave.operators.records import dead_letter_split
from orderweave.session import materialize
from orderweave.sources.snapshots import SnapshotStore
from orderweave.streaming.flows import run_batches
from orderweave.streaming.state import mutate_state


def stall_stream(counts: DataFrame, check: str, time: str, pending: str, place: str) -> DataFrame:
    """Per check the last count, the one before it, at how many times it was positive and had not fallen, and late counts.

    The count before is state, so it is known in the next micro-batch and after a restart with the same ``place``. Counts
    of a check are taken in order of their time; one that is not later than the last one taken is counted as late and
    changes nothing else. A micro-batch holds few counts of a check: they fit one frame.
    """
    kind = dict(counts.dtypes)[time]

    def change(held, rows):
        at, now, before, stalls, late = held
        for when, n in rows.sort_values(time)[[time, pending]].itertuples(index=False):
            if at is not None and when <= at:
                late += 1
                continue
            stalls += int(at is not None and n > 0 and n >= now)
            at, now, before = when, int(n), now
        return at, now, before, stalls, late

    found = mutate_state(
        counts.where(F.col(time).isNotNull() & F.col(pending).isNotNull()), check,
        f"`{time}` {kind}, `{pending}` long, previous long, stalls long, late long",
        lambda key: (None, None, None, 0, 0), change, place)
    return found.select(check, time, pending, "previous", "stalls", "late")


def broken_rules(contract: Sequence[Rule]) -> Column:
    """The broken rules of a parsed record as ``field:rule``, comma-joined; null if it keeps them all.

    A malformed record breaks its schema alone, as its fields cannot be judged.
    """
    malformed = F.col(CORRUPT).isNotNull()
    named = [F.when(malformed, "msg_value:schema")] + [
        F.when(~malformed & F.coalesce(r.broken, F.lit(False)), f"{r.field}:{r.name}") for r in contract]
    return F.nullif(F.concat_ws(",", *named), F.lit(""))


def contract_stream(store: SnapshotStore, records: DataFrame, contract: Sequence[Rule], name: str,
                    columns: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(accepted, dead letters) of a record stream: record_id, ``columns``, target_topic and violations.

    Both parts of a micro-batch become visible with one commit, so a record is in one of them or, until then, in
    none. A batch that is replayed is skipped by its commit key; the checkpoint lies in the store.
    """
    wanted = ["record_id", *columns, "target_topic", "violations"]

    def judged(batch: DataFrame) -> DataFrame:
        return dead_letter_split(batch, contract).withColumn("violations", broken_rules(contract)).select(*wanted)

    def save(batch: DataFrame, batch_id: int) -> None:
        run_key = f"{name}/{batch_id}"
        if store.committed(run_key):
            return
        rows = materialize(judged(batch), "judged", reader=store.spark)
        store.commit(run_key, added={
            "accepted": rows.where("violations IS NULL"), "dead_letters": rows.where("violations IS NOT NULL")})

    run_batches(records, save, name, checkpoint=f"{store.root}/streams/{name}")
    empty = judged(store.spark.createDataFrame([], records.schema))
    return tuple(store.load_log(log, lambda: empty, run_id=name) for log in ("accepted", "dead_letters"))
