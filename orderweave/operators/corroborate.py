"""Checks that stored state still agrees with the events behind it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderweave.functions.rules import Rule, violations
from orderweave.operators.allocate import allocate_requests, next_inventory, next_person
from orderweave.operators.counts import request_count
from orderweave.operators.ordering import ROWS_PER_RANGE, with_previous
from orderweave.schemas import CREDIT, DEBIT, EXECUTED
from orderweave.session import materialize


def snapshot_compare(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Added, removed and changed keys of two snapshots that are unique on ``key``; nulls equal nulls."""
    columns = [c for c in before.columns if c != key]
    old = before.select(key, F.struct(*columns).alias("old"))
    new = after.select(key, F.struct(*columns).alias("new"))
    change = (
        F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed")
        .when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    )
    return old.join(new, key, "full_outer").withColumn("change", change).where(F.col("change").isNotNull()).select(
        key, "change"
    )


def replay_and_diff(expected: DataFrame, stored: DataFrame, key: str, column: str) -> DataFrame:
    """Keys whose stored value differs from the value recomputed out of the log."""
    left = expected.select(key, F.col(column).alias("expected"))
    right = stored.select(key, F.col(column).alias("stored"))
    return left.join(right, key, "full_outer").where(~F.col("expected").eqNullSafe(F.col("stored")))


def replay_state(request: DataFrame, product: DataFrame, opening: tuple[DataFrame, DataFrame],
                 stored: tuple[DataFrame, DataFrame]) -> DataFrame:
    """(resource, id, expected, stored) where stored stock or balance is not what the log gives from the opening versions.

    ``opening`` and ``stored`` are versions of inventory and person, the log goes through the allocation once for both.
    """
    inventory, person = opening
    decided = allocate_requests(request, inventory, product, person)
    sides = [
        ("stock", "product_id", "qty", next_inventory(inventory, decided), stored[0]),
        ("balance", "person_id", "balance", next_person(person, decided), stored[1]),
    ]
    found = [
        replay_and_diff(expected, kept, key, column).select(
            F.lit(name).alias("resource"), F.col(key).alias("id"), F.col("expected").cast("decimal(20,2)").alias("expected"),
            F.col("stored").cast("decimal(20,2)").alias("stored"))
        for name, key, column, expected, kept in sides
    ]
    return found[0].unionByName(found[1])


def totals_reconcile(decided: DataFrame, stock: tuple[DataFrame, DataFrame], money: tuple[DataFrame, DataFrame]) -> DataFrame:
    """One row for stock and one for balance: total before, total moved by executed requests, total after, and whether they agree.

    ``stock`` and ``money`` are the versions of inventory and person before and after.
    """
    wide = "decimal(38,2)"
    sign = F.when(F.col("operation") == CREDIT, -1).otherwise(1)
    fresh = decided.where((F.col("result") == EXECUTED) & F.col("stock_before").isNotNull())
    rows = []
    for name, column, amount, (before, after) in (("stock", "qty", "qty", stock), ("balance", "balance", "cost", money)):
        def total(df: DataFrame, value: Column) -> DataFrame:
            return df.agg(F.coalesce(F.sum(value), F.lit(0)).cast(wide).alias("v"))

        # three one-row tables; a join on a constant would do the same
        rows.append(
            total(before, F.col(column)).select(F.lit(name).alias("resource"), F.col("v").alias("opening"))
            .join(total(fresh, sign * F.col(amount)).select(F.lit(name).alias("resource"), F.col("v").alias("moved")), "resource")
            .join(total(after, F.col(column)).select(F.lit(name).alias("resource"), F.col("v").alias("closing")), "resource"))
    both = rows[0].unionByName(rows[1])
    return both.withColumn("reconciled", F.col("opening") + F.col("moved") == F.col("closing"))


def shadow_results(primary: DataFrame, shadow: DataFrame) -> DataFrame:
    """Requests on whose result or reason two processors of one log disagree; one that only one of them has shows up too."""
    fields = ("result", "reason")
    old = primary.select("request_id", F.lit(True).alias("__old"), *[F.col(c).alias(f"primary_{c}") for c in fields])
    new = shadow.select("request_id", F.lit(True).alias("__new"), *[F.col(c).alias(f"shadow_{c}") for c in fields])
    same = F.col("__old").eqNullSafe(F.col("__new"))
    for c in fields:
        same &= F.col(f"primary_{c}").eqNullSafe(F.col(f"shadow_{c}"))
    return old.join(new, "request_id", "full_outer").where(~same).drop("__old", "__new")


def count_reconcile(request: DataFrame) -> DataFrame:
    """Do the status counts add up to the number of rows, with nothing unknown?"""
    buckets = ["nbr_pending", "nbr_back_order", "nbr_executed", "nbr_error", "nbr_unknown"]
    counts = request_count(request, F.count("*").alias("total"))
    bucket_sum = sum((F.coalesce(c, F.lit(0)) for c in buckets[1:]), F.coalesce(buckets[0], F.lit(0)))
    unknown = F.coalesce("nbr_unknown", F.lit(0))
    return counts.select(
        "total", bucket_sum.alias("bucket_sum"), unknown.alias("nbr_unknown"),
        ((F.col("total") == bucket_sum) & (unknown == 0)).alias("reconciled"),
    )


def row_digest(key: str, columns: Sequence[str]) -> Column:
    """SHA-256 of a row. Each value is written with its length before it, and null as a dash, so different rows never read alike."""
    def written(column: str) -> Column:
        value = F.col(column).cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[written(c) for c in (key, *columns)]), 256)


def _leading(digest: Column) -> Column:
    """The leading 60 bits of a digest as a number that can be summed."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(20,0)")


def state_checksum(table: DataFrame, key: str, columns: Sequence[str], buckets: int = 16) -> DataFrame:
    """Fingerprint per key bucket: row count and, as text, the sum of the leading 60 bits of each row's SHA-256.

    The sum does not depend on row order, so partial sums combine on the map side and only ``buckets`` rows travel.
    """
    return table.groupBy(F.pmod(key, F.lit(buckets)).cast("long").alias("bucket")).agg(
        F.count("*").alias("n"), F.sum(_leading(row_digest(key, columns))).cast("string").alias("checksum")
    )


#: Hexadecimal digits of the key's hash that a level of the hash tree goes on, and rows that a leaf should hold.
TREE_STEP = 2
LEAF_ROWS = 64


@dataclass(frozen=True)
class HashTree:
    """Levels of fingerprints over one table, from the root's children down to leaves of few rows.

    ``rows`` is (key, place, d0, d1, d2): the hash of the key decides the place, three numbers of 60 bits of the row's digest are what
    is summed. A node is a prefix of the place; ``levels`` holds (node, n, s0, s1, s2) for each length of prefix, each level made
    from the one below it, so the table is read and shuffled once.
    """

    key: str
    rows: DataFrame
    levels: tuple[DataFrame, ...]


_SUMS = ("s0", "s1", "s2")


def tree_depth(rows: int) -> int:
    """Levels that a table of so many rows needs for leaves of about ``LEAF_ROWS``: it follows the data and has no top."""
    depth, leaves = 1, 16 ** TREE_STEP
    while leaves * LEAF_ROWS < rows:
        depth, leaves = depth + 1, leaves * 16 ** TREE_STEP
    return depth


def hash_tree(table: DataFrame, key: str, columns: Sequence[str], depth: int) -> HashTree:
    """The tree of a table of ``depth`` levels; two tables are compared by trees of one depth.

    A null key has a place too. Every level is written to the shared folder.
    """
    digest = row_digest(key, columns)
    place = F.substring(F.sha2(F.coalesce(F.col(key).cast("string"), F.lit("")), 256), 1, TREE_STEP * depth)
    parts = [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)").alias(f"d{i}") for i in range(3)]
    rows = materialize(table.select(key, place.alias("place"), *parts), "tree-rows")
    level = rows.groupBy(F.col("place").alias("node")).agg(
        F.count("*").alias("n"), *[F.sum(f"d{i}").alias(c) for i, c in enumerate(_SUMS)])
    levels = [materialize(level, "tree-level")]
    for shorter in range(depth - 1, 0, -1):
        above = levels[0].groupBy(F.substring("node", 1, TREE_STEP * shorter).alias("node")).agg(
            F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in _SUMS])
        levels.insert(0, materialize(above, "tree-level"))
    return HashTree(key, rows, tuple(levels))


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes whose count or sums are not the same in both, or that only one has."""
    fields = ["n", *_SUMS]
    old = left.select("node", F.struct(*fields).alias("old"))
    new = right.select("node", F.struct(*fields).alias("new"))
    return old.join(new, "node", "full_outer").where(~F.col("old").eqNullSafe(F.col("new"))).select("node")


def tree_levels(left: HashTree, right: HashTree) -> list[tuple[DataFrame, DataFrame, DataFrame]]:
    """For each level the nodes read of both trees, and those that differ: only children of differing nodes are read."""
    found, above = [], None
    for mine, other in zip(left.levels, right.levels, strict=True):
        if above is not None:
            parent = F.expr(f"substring(node, 1, length(node) - {TREE_STEP})")
            mine, other = (
                level.withColumn("__above", parent).join(above.withColumnRenamed("node", "__above"), "__above", "left_semi")
                .drop("__above") for level in (mine, other))
        above = materialize(_differing(mine, other), "tree-differs")
        found.append((mine, other, above))
    return found


def tree_diff(left: HashTree, right: HashTree) -> DataFrame:
    """(key, change): keys ``added``, ``removed`` or ``changed`` from left to right. Keys are unique in each table.

    Below the last level only the rows of differing leaves are met with each other.
    """
    leaves = tree_levels(left, right)[-1][2].withColumnRenamed("node", "place")
    fields = F.struct("d0", "d1", "d2")
    old = left.rows.join(leaves, "place", "left_semi").select(left.key, fields.alias("old"))
    new = right.rows.join(leaves, "place", "left_semi").select(left.key, fields.alias("new"))
    both = old.withColumn("__key", F.col(left.key)).drop(left.key).join(
        new.withColumn("__other", F.col(left.key)).drop(left.key), F.col("__key").eqNullSafe(F.col("__other")), "full_outer")
    change = (F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed")
              .when(F.col("old") != F.col("new"), "changed"))
    return both.select(F.coalesce("__key", "__other").alias(left.key), change.alias("change")).where("change IS NOT NULL")


def tree_reads(left: HashTree, right: HashTree) -> DataFrame:
    """(level, nodes, read, differing): what a comparison reads of each level."""
    out = None
    for number, (level, (mine, other, differs)) in enumerate(
            zip(left.levels, tree_levels(left, right), strict=True), start=1):
        row = level.agg(F.count("*").alias("nodes")).select(F.lit(number).alias("level"), "nodes").join(
            mine.agg(F.count("*").alias("read")).select(F.lit(number).alias("level"), "read"), "level").join(
            differs.agg(F.count("*").alias("differing")).select(F.lit(number).alias("level"), "differing"), "level")
        out = row if out is None else out.unionByName(row)
    return out


def checksum_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Buckets in which two fingerprints differ."""
    return snapshot_compare(left, right, "bucket")


def sequence_gaps(events: DataFrame, key: str, seq: str, range_rows: int = ROWS_PER_RANGE) -> DataFrame:
    """Missing and repeated sequence numbers per entity: (key, kind, first_seq, last_seq, n).

    For a gap ``n`` is the number of missing values, for a duplicate the number of occurrences.
    """
    numbered = events.where(F.col(seq).isNotNull()).select(key, F.col(seq).cast("long").alias("__seq"))
    tallied = numbered.groupBy(key, "__seq").agg(F.count("*").alias("__n"))
    here, previous = F.col("__seq"), F.col("previous")

    def finding(test: Column, kind: str, first: Column, last: Column, n: Column) -> Column:
        return F.when(test, F.struct(F.lit(kind).alias("kind"), first.alias("first_seq"), last.alias("last_seq"),
                                     n.alias("n")))

    repeat = finding(F.col("__n") > 1, "duplicate", here, here, F.col("__n"))
    gap = finding(here - previous > 1, "gap", previous + 1, here - 1, here - previous - 1)
    stepped = with_previous(tallied, key, "__seq", range_rows)
    return stepped.select(key, F.explode(F.array_compact(F.array(repeat, gap))).alias("f")).select(key, "f.*")


def invariant_violations(checks: Sequence[tuple[DataFrame, str, Sequence[Rule]]]) -> DataFrame:
    """(entity_key, field, rule) over several tables; each is read once and filtered in place."""
    found = [
        violations(table, key, rules).select(F.col(key).alias("entity_key"), "field", "rule")
        for table, key, rules in checks
    ]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def movement_reconcile(executed: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Products whose change in stock is not the signed quantity of their executed requests.

    A product that moved and is in neither snapshot is reported too, with no actual change.
    """
    signed = F.when(F.col("operation") == CREDIT, -F.col("qty")).when(F.col("operation") == DEBIT, F.col("qty"))
    moved = executed.where(F.col("result") == EXECUTED).groupBy("product_id").agg(F.sum(signed).alias("__moved"))
    return (
        before.select("product_id", F.col("qty").alias("qty_before"))
        .join(after.select("product_id", F.col("qty").alias("qty_after")), "product_id", "full_outer")
        .join(moved, "product_id", "full_outer")
        .withColumn("expected_change", F.coalesce("__moved", F.lit(0)).cast("long"))
        .withColumn("actual_change", F.col("qty_after") - F.col("qty_before"))
        .where(~F.col("actual_change").eqNullSafe(F.col("expected_change")))
        .select("product_id", "expected_change", "actual_change")
    )


def shadow_compare(primary: DataFrame, shadow: DataFrame, key: str) -> DataFrame:
    """Keys on which two processors of the same input disagree."""
    return snapshot_compare(primary, shadow, key)


def agreement_rate(primary: DataFrame, shadow: DataFrame, key: str) -> DataFrame:
    """Number of keys, number of disagreements and the share in agreement, from one join."""
    columns = [c for c in primary.columns if c != key]
    old = primary.select(key, F.struct(*columns).alias("old"))
    new = shadow.select(key, F.struct(*columns).alias("new"))
    differs = (~F.col("old").eqNullSafe(F.col("new"))).cast("int")
    counts = old.join(new, key, "full_outer").agg(
        F.count("*").alias("n_keys"), F.coalesce(F.sum(differs), F.lit(0)).alias("n_diffs")
    )
    return counts.withColumn("agreement", F.try_divide(F.col("n_keys") - F.col("n_diffs"), F.col("n_keys")))


def stall_check(counts: DataFrame, time: str, pending: str) -> DataFrame:
    """Checks at which the pending count is positive and has not fallen since the check before.

    ``counts`` holds one row per check, so the single ordered window is over checks, not over requests.
    """
    order = W.partitionBy(F.lit(0)).orderBy(time)
    return (
        counts.withColumn("previous", F.lag(pending).over(order))
        .where((F.col(pending) > 0) & (F.col(pending) >= F.col("previous")))
        .select(time, pending, "previous")
    )


def compact_latest(records: DataFrame, key: str, order: str) -> DataFrame:
    """Latest record of each key, combined on the map side."""
    row = F.struct(*[F.col(c) for c in records.columns])
    return records.groupBy(key).agg(F.max_by(row, order).alias("__row")).select("__row.*")


def processed_inbox(events: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Events whose id is not in the table of processed ids."""
    return events.join(processed.select(key), key, "left_anti")


def outbox_relay(outbox: DataFrame, relayed: DataFrame, key: str) -> DataFrame:
    """Outbox rows that have not been published yet."""
    return outbox.join(relayed.select(key), key, "left_anti")


def partition_skew(records: DataFrame, partition: str = "partition_id") -> DataFrame:
    """Rows per partition and their ratio to the mean."""
    counts = records.groupBy(partition).agg(F.count("*").alias("n"))
    mean = F.avg("n").over(W.partitionBy(F.lit(0)))
    return counts.select(partition, "n", (F.col("n") / mean).alias("ratio"))


def split_event_types(events: DataFrame, kind: str, path: str) -> None:
    """One folder per type. Writing by partition column needs no shuffle, so a dominant type stays spread."""
    events.write.partitionBy(kind).parquet(path)


def lifecycle_order_violations(events: DataFrame, key: str, time: str, is_first: Column,
                               is_last: Column | None = None) -> DataFrame:
    """Entities with an event before their first marker or after their last one.

    Four extremes per key decide it, so one map-side combined aggregation is enough even for a hot key.
    """
    at = F.col(time)
    opened = F.min(F.when(is_first, at))
    closed = F.max(F.when(is_last, at)) if is_last is not None else F.lit(None).cast("timestamp_ntz")
    spans = events.groupBy(key).agg(
        F.min(at).alias("first_seen"), F.max(at).alias("last_seen"),
        opened.alias("opened_at"), closed.alias("closed_at"),
    )
    early = F.col("first_seen") < F.col("opened_at")
    late = F.coalesce(F.col("last_seen") > F.col("closed_at"), F.lit(False))
    return spans.where(early | late)


def checkpoint_events(batch: DataFrame, batch_id: int) -> DataFrame:
    """Progress rows of one batch: records and highest offset per partition."""
    return batch.groupBy("topic", "partition_id").agg(
        F.count("*").alias("n"), F.max("offset_id").alias("max_offset")
    ).withColumn("batch_id", F.lit(batch_id).cast("long"))


def contract_violations(parsed: DataFrame, rules: Sequence[Rule], key: str = "record_id") -> DataFrame:
    """(key, field, rule) for each record that breaks its schema or a value rule.

    A malformed record breaks the schema alone: its fields cannot be judged.
    """
    malformed = Rule("msg_value", "schema", F.col("corrupt").isNotNull())
    sound = [Rule(r.field, r.name, r.broken & F.col("corrupt").isNull()) for r in rules]
    return violations(parsed, key, [malformed, *sound])
