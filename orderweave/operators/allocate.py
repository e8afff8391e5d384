"""Allocation of stock and balance in request order.

A CREDIT takes stock of a product and money of a person if both suffice, otherwise it is back-ordered and takes
nothing; a DEBIT always gives both back. Every decision therefore depends on the earlier ones of the same product
*and* of the same person, and no partitioning separates the two.

How it is distributed
---------------------
* Requests are range-partitioned by (product, request) into *chunks* and once more by (person, request). Range
  partitioning cuts a hot key into as many chunks as its rows need, so no task ever sees a whole hot key.
* Both layouts are written as tables bucketed by chunk. Rounds then read them in place; only the failed requests
  and a few carried states are shuffled.
* A round walks every chunk in request order. The state a key has on entering a chunk comes from the chunk
  before. It is first assumed; the walk returns, with its result, by how much the entering state could differ
  without changing any decision, so the chunk ends can be chained exactly afterwards. A chunk is wrong only if
  its true entering state lies outside that margin; it is walked again in the next round.
* The product walk takes the balance failures of the round before as given, the person walk the stock failures.

* After the first round only the chunks that a changed decision or a changed entering state concerns are walked
  again; with few of them only their buckets are read.

* If the number of changed decisions falls so slowly that rounds would take longer, the requests behind the
  settled ones are finished in windows (see ``_in_windows``).

The loop stops when no chunk is left to walk. At that point each decision equals the serial one given the earlier
decisions, so by induction over the request order the whole result equals the serial result. Every round settles
at least the first wrong request, so the loop ends; there is no cap.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderweave.functions.numbers import COST
from orderweave.operators.filters import eligible_requests
from orderweave.operators.mutate import apply_movement
from orderweave.operators.views import enrich_requests
from orderweave.schemas import BACK_ORDER, CREDIT, DEBIT, ERROR, EXECUTED, MONEY, PENDING
from orderweave.session import materialize, scratch

#: Rows one task walks at a time, the fewest worth a task of their own, and the most chunks of a layout.
CHUNK_ROWS = 500_000
SMALL_CHUNK_ROWS = 25_000
MAX_CHUNKS = 50_000

#: Rounds to wait before windows are considered.
PATIENCE = 3

#: A walk may be limited to this many listed chunks, and this many limited walks follow a full one.
MAX_LISTED = 2_000
MAX_NARROW_WALKS = 10

_MESSAGE = "chunk int, kind string, id long, value long"
_WALKED = (
    "kind string, chunk int, key long, entered long, left long, slack long, gap long, failed boolean, "
    "request_id long, other_chunk int"
)
_WIDE = 2**62


@dataclass(frozen=True)
class Side:
    """One of the two resources: which columns hold its key, its amount and its opening state."""

    name: str
    key: str
    amount: str
    opening: str

    @property
    def chunk(self) -> str:
        return f"{self.name}_chunk"


STOCK = Side("stock", "product_id", "qty", "opening_stock")
BALANCE = Side("balance", "person_id", "cost_cents", "opening_cents")


# -- what a task does with one chunk --------------------------------------------------------------------------

def _walker(side: Side) -> Callable:
    """A function over one sorted chunk. It is built here so that tasks get it by value."""
    key, amount, opening = side.key, side.amount, side.opening
    wide = _WIDE

    def walk(rows, notes):
        """Returns (sorted rows, passes, state before each row, key segments)."""
        rows = rows.take(np.lexsort((rows["request_id"], rows[key]))).reset_index(drop=True)
        blocked = rows["request_id"].isin(notes.loc[notes["kind"] == "blocked", "id"]).tolist()
        carried = notes[notes["kind"] == "carry"]
        carry = dict(zip(carried["id"].tolist(), carried["value"].tolist()))
        passes, before, segments = [], [], []
        current, state, segment = None, 0, None
        columns = zip(rows["request_id"].tolist(), rows[key].tolist(), rows[amount].tolist(), rows[opening].tolist(),
                      rows["is_credit"].tolist(), blocked)
        for request, k, take, start, credit, stopped in columns:
            if k != current:
                if segment:
                    segment[2] = state
                current, state = k, carry.get(k, start)
                segment = [k, state, state, wide, wide, False, request]
                segments.append(segment)
            before.append(state)
            if not credit:
                passes.append(True)
                state += take
            elif state < take:
                passes.append(False)
                segment[4] = min(segment[4], take - state)
                segment[5] = True
            else:
                passes.append(True)
                segment[3] = min(segment[3], state - take)
                if not stopped:
                    state -= take
        if segment:
            segment[2] = state
        return rows, passes, before, segments

    return walk


def _round_task(side: Side, other: Side) -> Callable:
    """What a chunk reports: its failures, its first and last key segment, and where its decisions changed.

    A ``touched`` row names a chunk of the other side with the number (in ``key``) and the first of the changed
    decisions that concern it.
    """
    walk, other_chunk = _walker(side), other.chunk
    names = ["kind", "chunk", "key", "entered", "left", "slack", "gap", "failed", "request_id", "other_chunk"]
    unused = dict.fromkeys(names[3:7], 0) | {"failed": False}

    def task(key, rows, notes):
        chunk = int(key[0])
        out = [pd.DataFrame(columns=names)]
        if len(rows):
            rows, passes, _, segments = walk(rows, notes)
            failing = rows.loc[[not p for p in passes]]
            ends = segments if len(segments) == 1 else [segments[0], segments[-1]]
            out = [pd.DataFrame([("segment", chunk, *end, 0) for end in ends], columns=names)]
            # a column at a time: failures may be a third of all rows
            out.append(pd.DataFrame({"kind": "failed", "chunk": chunk, "key": 0, **unused, "request_id": failing["request_id"],
                                     "other_chunk": failing[other_chunk]}, columns=names))
            earlier = notes.loc[notes["kind"] == "earlier", "id"]
            changed = set(earlier.tolist()).symmetric_difference(failing["request_id"].tolist())
            touched = rows.loc[rows["request_id"].isin(changed)].groupby(other_chunk)["request_id"].agg(["size", "min"])
            out.append(pd.DataFrame({"kind": "touched", "chunk": chunk, "key": touched["size"], **unused,
                                     "request_id": touched["min"], "other_chunk": touched.index}, columns=names))
        return pd.concat([part for part in out if len(part)] or out, ignore_index=True)

    return task


def _chainer() -> Callable:
    """Chains the chunks of one key: the true entering state of each, and whether its decisions still stand.

    A shift ``d`` of the entering state keeps every decision while -slack <= d < gap and then moves the leaving
    state by ``d``. Beyond that the leaving state is only estimated and the chunk is marked open.
    """
    names = ["chunk", "entered", "left", "slack", "gap", "failed", "request_id"]

    def chain(segments):
        ordered = segments.sort_values("chunk")
        out, state = [], None
        for chunk, entered, left, slack, gap, failed, first in ordered[names].itertuples(index=False):
            if state is None:
                state = left
                continue
            shift = state - entered
            stands = -slack <= shift < gap
            out.append((int(chunk), "carry", int(ordered["key"].iloc[0]), int(state), int(not stands), int(first)))
            if stands:
                state = left + shift
            else:
                state = left if failed else max(0, left + shift)
        return pd.DataFrame(out, columns=["chunk", "kind", "id", "value", "open", "first"])

    return chain


# -- the distributed loop ---------------------------------------------------------------------------------------

class _Layout:
    """Requests of one side, bucketed by chunk so that rounds read them without a shuffle."""

    def __init__(self, rows: DataFrame, side: Side, other: Side, chunks: int):
        self.spark: SparkSession = rows.sparkSession
        self.side, self.other, self.chunks = side, other, chunks
        self.buckets = min(chunks, max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        self.table = f"orderweave_{side.name}_{uuid.uuid4().hex}"
        wanted = ["request_id", side.key, side.amount, side.opening, "is_credit", other.chunk]
        (
            rows.select(F.col(side.chunk).alias("chunk"), *dict.fromkeys(wanted))
            .repartition(self.buckets, "chunk")
            .write.bucketBy(self.buckets, "chunk").format("parquet")
            .option("path", scratch(self.spark, side.name)).saveAsTable(self.table)
        )
        self.rows = self.spark.table(self.table)
        self.failed: DataFrame | None = None
        self.segments: DataFrame | None = None
        self.carry: DataFrame | None = None
        self.pending: set[int] | None = None  # chunks to walk next; None is all of them
        self.changed = 0  # decisions that changed in the last walk
        self.first_open = self.first_loose = _WIDE  # first request of an open segment; or that or changed
        self._narrow_walks = 0

    def _notes(self, blocked: DataFrame | None, earlier: bool) -> DataFrame:
        empty = [F.lit(None).cast(kind).alias(name) for name, kind in (m.split() for m in _MESSAGE.split(", "))]
        notes = self.spark.range(0).select(*empty)
        zero = F.lit(0).cast("long").alias("value")
        if blocked is not None:
            notes = notes.unionByName(blocked.select(
                F.col("other_chunk").alias("chunk"), F.lit("blocked").alias("kind"), F.col("request_id").alias("id"),
                zero))
        if self.carry is not None:
            notes = notes.unionByName(self.carry.select("chunk", "kind", "id", "value"))
        if earlier and self.failed is not None:
            notes = notes.unionByName(self.failed.select(
                "chunk", F.lit("earlier").alias("kind"), F.col("request_id").alias("id"), zero))
        return notes

    def _with_notes(self, notes: DataFrame, chunks: list[int] | None = None):
        rows = self.rows
        if chunks is not None:
            rows, notes = (df.where(F.col("chunk").isin(chunks)) for df in (rows, notes))
        return rows.groupBy("chunk").cogroup(notes.groupBy("chunk"))

    def _selection(self) -> list[int] | None:
        """The pending chunks if they are few: then only their buckets are read. Walking more is never wrong."""
        few = self.pending is not None and len(self.pending) <= min(MAX_LISTED, self.chunks // 2)
        if few and self._narrow_walks < MAX_NARROW_WALKS:
            self._narrow_walks += 1
            return sorted(self.pending)
        self._narrow_walks = 0
        return None

    def walk(self, blocked: DataFrame | None) -> set[int]:
        """Walk the pending chunks; those still open stay pending. Returns the touched chunks of the other side."""
        path = scratch(self.spark, f"{self.side.name}-walk")
        task, chunks = _round_task(self.side, self.other), self._selection()
        notes = self._notes(blocked, earlier=True)
        self._with_notes(notes, chunks).applyInPandas(task, _WALKED).write.partitionBy("kind").parquet(path)
        walked = self.spark.read.schema(_WALKED).option("basePath", path).parquet(path)
        failed = walked.where("kind = 'failed'").select("chunk", "request_id", "other_chunk")
        segments = walked.where("kind = 'segment'").drop("kind")
        if chunks is not None:
            others = ~F.col("chunk").isin(chunks)
            failed = failed.unionByName(self.failed.where(others))
            segments = segments.unionByName(self.segments.where(others))
        self.failed, self.segments = failed, segments
        # At most two segments per chunk: the chain of a key is as short as its number of chunks.
        self.carry = segments.groupBy("key").applyInPandas(_chainer(), _MESSAGE + ", open long, first long")
        # One row per chunk: both lists are bounded by MAX_CHUNKS.
        no = F.lit(0).cast("long")
        found = self.carry.where("open = 1").select(F.lit(True).alias("here"), "chunk", no.alias("n"), "first").unionByName(
            walked.where("kind = 'touched'").groupBy(F.col("other_chunk").alias("chunk"))
            .agg(F.sum("key").alias("n"), F.min("request_id").alias("first"))
            .select(F.lit(False).alias("here"), "chunk", "n", "first")).collect()
        self.pending = {r.chunk for r in found if r.here}
        self.changed = sum(r.n for r in found)
        self.first_loose = min((r.first for r in found), default=_WIDE)
        self.first_open = min((r.first for r in found if r.here), default=_WIDE)
        return {r.chunk for r in found if not r.here}

    def touch(self, chunks: set[int]) -> None:
        if self.pending is not None:
            self.pending |= chunks

    @property
    def unsettled(self) -> bool:
        return self.pending is None or bool(self.pending)

    def outcome(self, blocked: DataFrame | None) -> DataFrame:
        """After settling: every row with its decision and the state it met."""
        walk, side = _walker(self.side), self.side
        kept = ["request_id", side.key, side.amount]
        names = [*kept, f"{side.name}_credit", f"{side.name}_ok", f"{side.name}_met"]

        def task(key, rows, notes):
            if not len(rows):
                return pd.DataFrame(columns=names)
            rows, passes, before, _ = walk(rows, notes)
            out = rows[kept].copy()
            out[names[-3]], out[names[-2]], out[names[-1]] = rows["is_credit"], passes, before
            return out

        types = ["long", "long", "long", "boolean", "boolean", "long"]
        schema = ", ".join(f"{n} {t}" for n, t in zip(names, types))
        return self._with_notes(self._notes(blocked, earlier=False)).applyInPandas(task, schema)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def _chunk_count(rows: int, spark: SparkSession, chunk_rows: int) -> int:
    wanted = max(-(-rows // chunk_rows), min(spark.sparkContext.defaultParallelism, -(-rows // SMALL_CHUNK_ROWS)))
    return max(1, min(MAX_CHUNKS, wanted))


def _lay_out(rows: DataFrame, side: Side, chunks: int) -> DataFrame:
    """Number the chunks of one side: contiguous ranges of (key, request) of about equal size."""
    return rows.repartitionByRange(chunks, side.key, "request_id").withColumn(side.chunk, F.spark_partition_id())


def _price(request: DataFrame, inventory: DataFrame, product: DataFrame, person: DataFrame) -> DataFrame:
    """Eligible requests with opening states; ``runs`` is false for those that end as ERROR."""
    rows = enrich_requests(eligible_requests(request), inventory, product, person)
    return rows.select(
        "request_id", "person_id", "product_id", "qty", "operation", "cost",
        (F.col("parents_found") & F.col("operation").isin(CREDIT, DEBIT)).alias("runs"),
        (F.col("operation") == CREDIT).alias("is_credit"),
        (F.col("cost") * 100).cast("long").alias("cost_cents"),
        F.col("stock").cast("long").alias("opening_stock"),
        (F.col("balance") * 100).cast("long").alias("opening_cents"),
    )


def _finish(request: DataFrame, refused: DataFrame, decided: DataFrame) -> DataFrame:
    """All requests: decided ones, those in error, and the untouched rest. Columns as in ``decided``."""
    def padded(rows: DataFrame, result) -> DataFrame:
        known = {"request_id", "person_id", "product_id", "qty", "operation"}
        return rows.select(*[
            F.col(f.name) if f.name in known
            else result.cast("int").alias("result") if f.name == "result"
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in decided.schema
        ])

    # Complement of the eligible ones; a null result is not eligible either.
    rest = request.where(~F.coalesce(F.col("result").isin(PENDING, BACK_ORDER), F.lit(False)))
    return decided.unionByName(padded(refused, F.lit(ERROR))).unionByName(padded(rest, F.col("result")))


def _operation(credit: str):
    return F.when(F.col(credit), CREDIT).otherwise(DEBIT).alias("operation")


def _money(cents: str, name: str):
    return (F.col(cents).cast("decimal(20,0)") / 100).cast(COST).alias(name)


def _settle(runs: DataFrame, goods: _Layout, money: _Layout, window_rows: int) -> int:
    """Walk until nothing is left to walk, or until windows are the shorter way to the end.

    Returns the first request that is not settled. All before it are: their decisions did not change in the last
    round, and every segment they lie in stands.
    """
    earlier, rounds = None, 0
    while goods.unsettled or money.unsettled:
        money.changed, money.first_loose = 0, _WIDE
        if goods.unsettled:
            money.touch(goods.walk(money.failed))
        if money.unsettled:
            goods.touch(money.walk(goods.failed))
        rounds += 1
        first_loose = min(goods.first_open, money.first_loose)
        if rounds >= PATIENCE and earlier and money.changed * 4 > earlier:
            ratio = money.changed / earlier
            rounds_left = math.log(money.changed + 1) / -math.log(ratio) if ratio < 1 else math.inf
            loose = runs.where(F.col("request_id") >= first_loose).count()
            if loose / window_rows < rounds_left:
                return first_loose
        earlier = money.changed
    return _WIDE


def _window_task() -> Callable:
    """Both tests at once, one request after the other, over one window."""
    kept = ["request_id", "product_id", "qty"]

    def task(rows):
        rows = rows.sort_values("request_id", ignore_index=True)
        stocks, balances, out = {}, {}, []
        columns = ["product_id", "person_id", "qty", "cost_cents", "is_credit", "stock_at", "cents_at"]
        for what, who, qty, cost, credit, stock, cents in rows[columns].itertuples(index=False):
            stock, cents = stocks.get(what, stock), balances.get(who, cents)
            enough, rich = not credit or stock >= qty, not credit or cents >= cost
            out.append((enough, stock, rich, cents))
            if enough and rich:
                sign = -1 if credit else 1
                stocks[what], balances[who] = stock + sign * qty, cents + sign * cost
        met = pd.DataFrame(out, columns=["stock_ok", "stock_met", "balance_ok", "balance_met"])
        return pd.concat([
            rows[kept], rows["is_credit"].rename("stock_credit"), met[["stock_ok", "stock_met"]],
            rows[["person_id", "cost_cents"]], met[["balance_ok", "balance_met"]]], axis=1)

    return task


def _moved(executed: DataFrame) -> DataFrame:
    """(key, side, delta) of executed rows."""
    sign = F.when(F.col("is_credit"), -1).otherwise(1)
    sides = F.array(*[
        F.struct(F.lit(side.name).alias("side"), F.col(side.key).alias("key"), (sign * F.col(side.amount)).alias("delta"))
        for side in (STOCK, BALANCE)
    ])
    return executed.select(F.explode(sides).alias("m")).groupBy("m.side", "m.key").agg(F.sum("m.delta").alias("delta"))


def _shifted(rows: DataFrame, moved: DataFrame, side: Side, column: str) -> DataFrame:
    delta = moved.where(F.col("side") == side.name).select(F.col("key").alias(side.key), "delta")
    return rows.join(delta, side.key, "left").withColumn(
        column, F.col(column) + F.coalesce("delta", F.lit(0))).drop("delta")


def _in_windows(runs: DataFrame, goods: _Layout, money: _Layout, first: int, window_rows: int) -> DataFrame:
    """Decide the requests from ``first`` on, window after window in request order.

    Where scarce products and scarce persons depend on each other closely, rounds settle only a short stretch
    each, because later decisions truly need the earlier ones. Then a window of bounded size is walked by one
    task with both tests at once, and only the movement per key goes from one window to the next.
    """
    spark = runs.sparkSession
    failed = goods.failed.select("request_id").unionByName(money.failed.select("request_id")).distinct()
    before = runs.where(F.col("request_id") < first).join(failed, "request_id", "left_anti")
    moved = materialize(_moved(before), "moved")
    loose = runs.where(F.col("request_id") >= first).select(
        "request_id", "product_id", "person_id", "qty", "cost_cents", "is_credit",
        F.col("opening_stock").alias("stock_at"), F.col("opening_cents").alias("cents_at"))
    windows = max(1, -(-loose.count() // window_rows))
    path = scratch(spark, "windows")
    loose.repartitionByRange(windows, "request_id").withColumn("window", F.spark_partition_id()).write.partitionBy(
        "window").parquet(path)
    schema = ("request_id long, product_id long, qty long, stock_credit boolean, stock_ok boolean, stock_met long, "
              "person_id long, cost_cents long, balance_ok boolean, balance_met long")
    layout = T.StructType([*loose.schema.fields, T.StructField("window", T.IntegerType())])
    stored = spark.read.schema(layout).option("basePath", path).parquet(path)
    out = scratch(spark, "window-out")
    for number in range(windows):
        rows = stored.where(F.col("window") == number)
        rows = _shifted(_shifted(rows, moved, STOCK, "stock_at"), moved, BALANCE, "cents_at")
        rows.groupBy("window").applyInPandas(_window_task(), schema).write.parquet(f"{out}/part={number}")
        if number + 1 < windows:
            done = spark.read.schema(schema).parquet(f"{out}/part={number}").where("stock_ok AND balance_ok")
            fresh = _moved(done.withColumnRenamed("stock_credit", "is_credit"))
            moved = materialize(
                moved.unionByName(fresh).groupBy("side", "key").agg(F.sum("delta").alias("delta")), "moved")
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out)


def allocate_requests(request: DataFrame, inventory: DataFrame, product: DataFrame, person: DataFrame,
                      chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Decide every eligible request in request order; see the module text for the method.

    Returns all requests with result, reason (``stock`` or ``balance`` for a back-order), cost and the stock and
    balance met. Requests that are not eligible keep their result; those without inventory, product or person and
    those with another operation end as ERROR.
    """
    spark = request.sparkSession
    chunks = _chunk_count(eligible_requests(request).count(), spark, chunk_rows)
    # Bounds of ranges are drawn from a run of their own: it reads files instead of repeating the joins.
    placed = _lay_out(materialize(_price(request, inventory, product, person), "joined"), STOCK, chunks)
    # Chunk numbers depend on sampled range bounds: they are fixed by writing them once.
    placed = materialize(_lay_out(placed, BALANCE, chunks), "priced")
    runs = placed.where("runs")
    goods, money = _Layout(runs, STOCK, BALANCE, chunks), _Layout(runs, BALANCE, STOCK, chunks)
    try:
        first_loose = _settle(runs, goods, money, chunk_rows)
        settled = F.col("request_id") < first_loose
        both = F.col("stock_ok") & F.col("balance_ok")
        met = goods.outcome(money.failed).where(settled).join(
            money.outcome(goods.failed).where(settled).drop("balance_credit"), "request_id")
        if first_loose < _WIDE:
            met = met.unionByName(_in_windows(runs, goods, money, first_loose, chunk_rows))
        decided = met.select(
            "request_id", "person_id", "product_id", "qty", _operation("stock_credit"),
            F.when(both, EXECUTED).otherwise(BACK_ORDER).alias("result"),
            F.when(~F.col("stock_ok"), "stock").when(~F.col("balance_ok"), "balance").alias("reason"),
            _money("cost_cents", "cost"), F.col("stock_met").alias("stock_before"),
            _money("balance_met", "balance_before"),
        )
        decided = materialize(decided, "decided")
    finally:
        goods.drop()
        money.drop()
    return _finish(request, placed.where("NOT runs"), decided)


def allocate_stock_only(request: DataFrame, inventory: DataFrame, product: DataFrame, person: DataFrame,
                        chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The same without the balance test: one resource, so walks exchange nothing but the chunk ends."""
    spark = request.sparkSession
    chunks = _chunk_count(eligible_requests(request).count(), spark, chunk_rows)
    joined = materialize(_price(request, inventory, product, person), "joined")
    placed = materialize(_lay_out(joined, STOCK, chunks), "priced")
    goods = _Layout(placed.where("runs"), STOCK, STOCK, chunks)
    try:
        while goods.unsettled:
            goods.walk(None)
        decided = goods.outcome(None).select(
            "request_id", "product_id", "qty", _operation("stock_credit"),
            F.when(F.col("stock_ok"), EXECUTED).otherwise(BACK_ORDER).alias("result"),
            F.when(~F.col("stock_ok"), "stock").alias("reason"), F.col("stock_met").alias("stock_before"),
        )
        decided = materialize(decided, "decided")
    finally:
        goods.drop()
    return _finish(request, placed.where("NOT runs"), decided)


def credit_in_order(inventory: DataFrame, credit: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Guarded credits, any number to an inventory row: each is subtracted if the stock that the earlier ones left
    covers it, otherwise it is a BACK_ORDER and takes nothing.

    Credits: (inventory_id, request_id, credit_qty) with unique request ids and quantities that are not null; those
    without an inventory row give none, as in ``mutate.conditional_credit``. One resource: the walk of ``allocate_stock_only``.
    """
    # The walk calls its key product_id; here it is the inventory row. Its own exchange on both sides of the join.
    opened = credit.join(inventory.select("inventory_id", "qty"), "inventory_id").select(
        F.col("inventory_id").alias("product_id"), "request_id", F.col("credit_qty").cast("long").alias("qty"),
        F.lit(True).alias("is_credit"), F.col("qty").cast("long").alias("opening_stock"))
    opened = materialize(opened, "opened")
    chunks = _chunk_count(opened.count(), credit.sparkSession, chunk_rows)
    goods = _Layout(materialize(_lay_out(opened, STOCK, chunks), "credits"), STOCK, STOCK, chunks)
    try:
        while goods.unsettled:
            goods.walk(None)
        met = F.col("stock_met")
        decided = materialize(goods.outcome(None).select(
            F.col("product_id").alias("inventory_id"), "request_id", met.alias("qty_before"),
            F.when(F.col("stock_ok"), met - F.col("qty")).otherwise(met).alias("qty_after"),
            F.when(F.col("stock_ok"), EXECUTED).otherwise(BACK_ORDER).alias("result")), "credited")
    finally:
        goods.drop()
    return decided


def executed_movement(decided: DataFrame, key: str, amount: str) -> DataFrame:
    """Signed movement per key: what a CREDIT takes and a DEBIT gives back.

    Only requests decided by this run count; those executed earlier met no stock here.
    """
    signed = F.when(F.col("operation") == CREDIT, -F.col(amount)).otherwise(F.col(amount))
    fresh = (F.col("result") == EXECUTED) & F.col("stock_before").isNotNull()
    return decided.where(fresh).groupBy(key).agg(
        F.sum(signed).alias("delta")
    )


def next_inventory(inventory: DataFrame, decided: DataFrame) -> DataFrame:
    return apply_movement(inventory, "product_id", "qty", executed_movement(decided, "product_id", "qty"))


def next_person(person: DataFrame, decided: DataFrame) -> DataFrame:
    return apply_movement(person, "person_id", "balance", executed_movement(decided, "person_id", "cost")).withColumn(
        "balance", F.col("balance").cast(MONEY))
