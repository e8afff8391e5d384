"""Table changes as batch jobs: a snapshot and a change set give the next snapshot with what was refused."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweave.schemas import BACK_ORDER, EXECUTED, MONEY, PENDING, RESULT
from orderweave.session import materialize

REFILL_RANGE = (1, 1000)


def _check_refill(amount: float) -> None:
    low, high = REFILL_RANGE
    if not low <= amount <= high:
        raise ValueError(f"a refill must be {low} to {high}")


def refill_inventory(inventory: DataFrame, qty: int) -> DataFrame:
    _check_refill(qty)
    return inventory.withColumn("qty", F.col("qty") + F.lit(qty))


def refill_balances(person: DataFrame, amount: int | float | str) -> DataFrame:
    _check_refill(float(amount))
    return person.withColumn("balance", (F.col("balance") + F.lit(str(amount)).cast(MONEY)).cast(MONEY))


def reset_results(request: DataFrame, result: int) -> DataFrame:
    if result not in RESULT.values():
        raise ValueError(f"unknown result code {result}")
    return request.withColumn("result", F.lit(result).cast("int"))


def movement_by_inventory(request: DataFrame, inventory: DataFrame) -> DataFrame:
    """Total quantity per inventory row of the given requests: summed per product first, then joined."""
    per_product = request.groupBy("product_id").agg(F.sum("qty").alias("delta"))
    return per_product.join(inventory.select("product_id", "inventory_id"), "product_id").select(
        "inventory_id", "delta"
    )


def _shift(table: DataFrame, key: str, column: str, deltas: DataFrame, sign: int) -> DataFrame:
    kind = table.schema[column].dataType
    total = deltas.groupBy(key).agg(F.sum("delta").alias("__delta"))
    moved = F.col(column) + F.lit(sign) * F.coalesce(F.col("__delta"), F.lit(0))
    return table.join(total, key, "left").withColumn(column, moved.cast(kind)).select(*table.columns)


def apply_debits(inventory: DataFrame, deltas: DataFrame) -> DataFrame:
    """Add ``delta`` per inventory id."""
    return _shift(inventory, "inventory_id", "qty", deltas, 1)


def apply_credits(inventory: DataFrame, deltas: DataFrame) -> DataFrame:
    """Subtract ``delta`` per inventory id; there is no floor."""
    return _shift(inventory, "inventory_id", "qty", deltas, -1)


def apply_movement(table: DataFrame, key: str, column: str, movement: DataFrame) -> DataFrame:
    """Add signed ``delta`` per key to any counter column."""
    return _shift(table, key, column, movement, 1)


class Change(NamedTuple):
    """``snapshot``: the table afterwards. ``judged``: every row or id asked for, with its ``status``, written down."""

    snapshot: DataFrame
    judged: DataFrame

    def affected(self) -> DataFrame:
        """status and n: how many rows or ids met which fate."""
        return self.judged.groupBy("status").agg(F.count("*").alias("n"))


def first_come(rows: DataFrame, seq: str, groups: Sequence[Sequence[str]]) -> DataFrame:
    """``seq`` of the rows a row-by-row insert in ``seq`` order takes, where rows may not share the values of any group.

    A row is taken if no row taken earlier shares its values in some group; a null in a group shares with nothing. In a
    round, rows that are first of all undecided ones in each of their groups are taken, and rows that share a value with
    one of these are refused; what is left waits for the next round. The earliest undecided row is always taken, so it
    ends; there are as many rounds as the longest chain of rows that each wait for the one before, mostly one or two.
    Values are joined as one row each, written down, so a value that very many rows have stays split over tasks.
    """
    columns = list(dict.fromkeys(c for g in groups for c in g))
    left = materialize(rows.select(seq, *columns), "undecided")
    taken = left.limit(0).select(seq)
    while not left.isEmpty():
        firsts, judged, wins = [], left, F.lit(True)
        for n, group in enumerate(groups):
            firsts.append(materialize(
                left.dropna(subset=list(group)).groupBy(*group).agg(F.min(seq).alias(f"__first{n}")), "first-values"))
            judged = judged.join(firsts[n], list(group), "left")
            wins &= F.col(f"__first{n}").isNull() | (F.col(f"__first{n}") == F.col(seq))
        judged = materialize(judged.select(seq, *columns, wins.alias("__wins")), "judged")
        winners = judged.where("__wins").select(seq)
        rest, free = judged.where("NOT __wins"), F.lit(True)
        for n, group in enumerate(groups):
            gone = firsts[n].join(winners, F.col(f"__first{n}") == F.col(seq), "left_semi")
            rest = rest.join(materialize(gone.withColumn(f"__gone{n}", F.lit(True)), "gone").drop(f"__first{n}"), list(group), "left")
            free &= F.col(f"__gone{n}").isNull()
        left = materialize(rest.where(free).select(seq, *columns), "undecided")
        taken = taken.unionByName(winners)
    return taken


def insert_with_constraints(
    new: DataFrame,
    existing: DataFrame,
    key: str,
    seq: str,
    not_null: list[str],
    parents: Mapping[str, DataFrame],
    unique: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """Each new row with ``status``: accepted, or the constraint that refuses it.

    The answer is that of inserting row by row in ``seq`` order, a number that tells the new rows apart: a refused row
    stands in nobody's way. ``parents`` maps a foreign-key column to the table that owns it (unique on the column of the
    same name). Winners are joined back on (key, seq), so a key repeated any number of times stays spread over tasks.
    ``unique`` lists further sets of columns that may occur once, in the table and among the new rows; a row with a
    null in such a set meets no other. A null key is refused.
    """
    not_null = list(dict.fromkeys([key, *not_null]))
    checked = new
    missing: list[tuple[str, Column]] = []
    for column, parent in parents.items():
        mark = f"__has_{column}"
        checked = checked.join(parent.select(column).withColumn(mark, F.lit(True)), column, "left")
        missing.append((f"missing_{column.removesuffix('_id')}", F.col(mark).isNull()))
    # Stored keys are unique: a key repeated in the batch only grows the left side, which AQE splits.
    taken = existing.select(key).withColumn("__taken", F.lit(True))
    checked = checked.join(taken, key, "left")

    for n, columns in enumerate(unique):
        stored = existing.select(*columns).distinct().withColumn(f"__taken{n}", F.lit(True))
        checked = checked.join(stored, list(columns), "left")

    reason = F.lit(None).cast("string")
    for n, columns in reversed(list(enumerate(unique))):
        reason = F.when(F.col(f"__taken{n}"), "duplicate_" + "_".join(columns)).otherwise(reason)
    reason = F.when(F.col("__taken"), "duplicate_key").otherwise(reason)
    for name, broken in reversed(missing):
        reason = F.when(broken, name).otherwise(reason)
    for column in reversed(not_null):
        reason = F.when(F.col(column).isNull(), "null_" + column).otherwise(reason)
    # Used twice below: written once, so that the joins run once.
    checked = materialize(checked.select(*new.columns, reason.alias("__reason")), "checked")

    valid = checked.where(F.col("__reason").isNull())
    if unique:
        first = materialize(first_come(valid, seq, [[key], *unique]), "taken").withColumn("__first", F.lit(True))
        judged = checked.join(first, seq, "left")
    else:
        first = valid.groupBy(key).agg(F.min(seq).alias(seq)).withColumn("__first", F.lit(True))
        judged = checked.join(first, [key, seq], "left")
    wins = F.coalesce("__first", F.lit(False))
    status = F.coalesce("__reason", F.when(wins, "accepted").otherwise("duplicate_in_batch"))
    return judged.select(*new.columns, status.alias("status"))


def insert_rows(table: DataFrame, new: DataFrame, key: str, seq: str, not_null: list[str],
                parents: Mapping[str, DataFrame], unique: Sequence[Sequence[str]] = ()) -> Change:
    """The table with the rows that `insert_with_constraints` accepts; columns a new row lacks are null."""
    judged = materialize(insert_with_constraints(new, table, key, seq, not_null, parents, unique), "inserted")
    fields = [(F.col(f.name) if f.name in new.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema]
    return Change(table.unionByName(judged.where("status = 'accepted'").select(*fields)), judged)


def update_by_id(table: DataFrame, changes: DataFrame, key: str, order: str | None = None,
                 unique: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Next snapshot with ``status``: unchanged, updated, or not_found for a change without a row.

    Changes are unique on the key; where they may not be, ``order`` names the column by which the last one wins.
    ``unique`` lists sets of columns that may occur once (a null meets no other). A change is refused as ``duplicate_...``,
    and its row stays, if another stored row has its values, even one that changes too; of changes with equal values, the
    one with the smallest key that is not refused otherwise is made and the others are ``duplicate_in_batch``.
    """
    if order is not None:
        row = F.struct(*table.columns)
        changes = changes.groupBy(key).agg(F.max_by(row, order).alias("__row")).select("__row.*")
    refusal = F.lit(None).cast("string")
    if unique:
        changes = changes.select(*table.columns)
        for n, columns in enumerate(unique):
            stored = table.select(*columns, F.col(key).alias(f"__holder{n}"))
            changes = changes.join(stored, list(columns), "left")
            refusal = F.coalesce(refusal, F.when(F.col(f"__holder{n}") != F.col(key), "duplicate_" + "_".join(columns)))
        known = changes.join(table.select(key), key, "left_semi")
        changes = materialize(changes.select(*table.columns, refusal.alias("__refusal")), "changes")
        valid = changes.where("__refusal IS NULL").join(known.select(key), key, "left_semi")
        made = materialize(first_come(valid, key, unique), "made").withColumn("__made", F.lit(True))
        changes = changes.join(made, key, "left")
        refusal = F.coalesce(F.col("new.__refusal"), F.when(F.col("new.__made").isNull(), "duplicate_in_batch"))
    old, new = table.alias("old"), changes.alias("new")
    known = F.col(f"old.{key}").isNotNull()
    asked = F.col(f"new.{key}").isNotNull()
    hit = asked & (refusal.isNull() | ~known)
    status = F.when(~known, "not_found").when(hit, "updated").when(asked, refusal).otherwise("unchanged")
    fields = [
        F.when(hit, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in table.columns
    ]
    return old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer").select(
        *fields, status.alias("status")
    )


def delete_restrict(table: DataFrame, ids: DataFrame, key: str, children: list[DataFrame]) -> DataFrame:
    """Status of each id asked to go: deleted, blocked (a child still points to it) or not_found.

    Children are reduced to distinct keys on the map side, so a parent with very many children costs one row.
    """
    asked = ids.select(key).distinct().join(table.select(key).withColumn("__known", F.lit(True)), key, "left")
    blocked = F.lit(False)
    for n, child in enumerate(children):
        used = child.select(key).distinct().withColumn(f"__child{n}", F.lit(True))
        asked = asked.join(used, key, "left")
        blocked = blocked | F.col(f"__child{n}").isNotNull()
    status = F.when(F.col("__known").isNull(), "not_found").when(blocked, "blocked").otherwise("deleted")
    return asked.select(key, status.alias("status"))


def delete_rows(table: DataFrame, ids: DataFrame, key: str, children: list[DataFrame]) -> Change:
    """The table without the ids that `delete_restrict` lets go."""
    judged = materialize(delete_restrict(table, ids, key, children), "deleted")
    return Change(table.join(judged.where("status = 'deleted'").select(key), key, "left_anti").select(*table.columns), judged)


def delete_all(table: DataFrame, key: str, children: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(empty snapshot, or the table unchanged when any child row points to it; one-row report)."""
    refused = any(not child.where(F.col(key).isNotNull()).isEmpty() for child in children)
    report = table.agg(F.count("*").alias("rows_before")).withColumn(
        "rows_after", F.col("rows_before") if refused else F.lit(0).cast("long")
    ).withColumn("status", F.lit("refused" if refused else "deleted"))
    return (table if refused else table.limit(0)), report


def conditional_credit(inventory: DataFrame, credit: DataFrame) -> DataFrame:
    """A credit is subtracted only if the stock covers it; otherwise BACK_ORDER.

    One update of a row at a time: of several credits of one inventory row the first by request id is decided, the
    others stay PENDING for a try on the next snapshot. Allocation in request order decides them all at once.
    """
    first = credit.groupBy("inventory_id").agg(F.min("request_id").alias("__first"))
    enough = F.col("qty") >= F.col("credit_qty")
    turn = F.col("request_id") == F.col("__first")
    # its own exchange on both sides of each join, so that a row with very many credits can be split
    guarded = materialize(inventory.join(first, "inventory_id"), "guarded")
    return guarded.join(credit, "inventory_id").select(
        "inventory_id", "request_id", F.col("qty").alias("qty_before"),
        F.when(turn & enough, F.col("qty") - F.col("credit_qty")).otherwise(F.col("qty")).alias("qty_after"),
        F.when(~turn, PENDING).when(enough, EXECUTED).otherwise(BACK_ORDER).alias("result"),
    )


def optimistic_update(table: DataFrame, changes: DataFrame, key: str, column: str,
                      order: str | None = None) -> DataFrame:
    """Apply a change only where its expected version is the stored one.

    Changes: (key, expected_version, new value). Status: applied (version moves on), stale (to be retried) or
    missing. Of several changes that expect the stored version, the first by ``order``, a column that tells the
    changes of a key apart, is applied and the others are stale; without ``order`` the one with the smallest value.
    """
    order = order or "__new"
    changes = changes.withColumnRenamed(column, "__new")
    first = changes.groupBy(key, "expected_version").agg(F.min(F.struct(order, "__new")).alias("__first"))
    first = materialize(first.select(
        F.col(key).alias("__key"), F.col("expected_version").alias("version"), "__first"), "first-changes")
    stored = materialize(
        table.join(first, (F.col(key) == F.col("__key")) & (first["version"] == table["version"]), "left")
        .select(*[table[c] for c in table.columns], "__first"), "versions")
    known = F.col("version").isNotNull()
    fits = (F.col("version") == F.col("expected_version")) & F.struct(order, "__new").eqNullSafe(F.col("__first"))
    return changes.join(stored, key, "left").select(
        key,
        F.when(~known, "missing").when(fits, "applied").otherwise("stale").alias("status"),
        F.when(fits, F.col("__new")).otherwise(F.col(column)).alias(column),
        F.when(fits, F.col("version") + 1).otherwise(F.col("version")).alias("version"),
    )
