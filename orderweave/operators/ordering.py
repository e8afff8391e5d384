"""Positions and predecessors inside very large ordered groups.

A plain window over a key puts the whole key into one task. These helpers cut every key into cells of a fixed
width of the (integer) order column first, so a task sees at most one cell, and carry totals between cells with a
second, far smaller window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderweave.session import materialize

#: Rows that one range of `running_total` holds, about.
ROWS_PER_RANGE = 1 << 18
#: Unique integers: a cell can hold no more rows than its width.
CELL_WIDTH = 1 << 18


def cell_of(order: str, width: int) -> Column:
    """Floor division that also holds for negative numbers."""
    value = f"CAST(`{order}` AS BIGINT)"
    return F.expr(f"({value} - pmod({value}, {width})) div {width}")


def ordered_index(df: DataFrame, keys: Sequence[str], order: str, out: str = "idx",
                  width: int = CELL_WIDTH) -> DataFrame:
    """Dense 0-based position of each row among the rows of its key, by the unique integer ``order``."""
    keys = list(keys)
    cells = df.withColumn("__cell", cell_of(order, width))
    inside = W.partitionBy(*keys, "__cell").orderBy(order)
    before = W.partitionBy(*(keys or [F.lit(0)])).orderBy("__cell").rowsBetween(W.unboundedPreceding, -1)
    base = (
        cells.groupBy(*keys, "__cell").agg(F.count("*").alias("__n"))
        .select(*keys, "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    )
    return (
        cells.withColumn("__in", F.row_number().over(inside))
        .join(base, [*keys, "__cell"])
        .select(*df.columns, (F.col("__base") + F.col("__in") - 1).cast("long").alias(out))
    )


def with_previous(values: DataFrame, key: str, order: str, range_rows: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds ``previous``: the value of ``order`` before each row among the rows of its key, null for the first.

    ``values`` holds each (key, order) once. Ranges of (key, order) hold about ``range_rows`` rows however far apart the values
    are, so a hot key with sparse values spreads too. Inside a range it is a window; between ranges of a key the
    largest value of the range before is carried, one row for each. The numbers of ranges are fixed by writing them.
    """
    spark = values.sparkSession
    came = materialize(values, "unordered")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-came.count() // range_rows))
    ranged = materialize(
        came.repartitionByRange(ranges, key, order).withColumn("__range", F.spark_partition_id()), "ordered")
    ahead = W.partitionBy("__of").orderBy("__at")
    ends = (
        ranged.groupBy(F.col(key).alias("__of"), F.col("__range").alias("__at")).agg(F.max(order).alias("__hi"))
        .withColumn("__before", F.lag("__hi").over(ahead)).drop("__hi")
    )
    inside = F.lag(order).over(W.partitionBy(key, "__range").orderBy(order))
    same = F.col(key).eqNullSafe(F.col("__of")) & (F.col("__range") == F.col("__at"))
    return (
        ranged.withColumn("__inside", inside).join(ends, same)
        .select(*values.columns, F.coalesce("__inside", "__before").alias("previous"))
    )


def running_total(df: DataFrame, order: Sequence[str], out: str, by: Sequence[str] = (),
                  value: Column | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` (by default the number of rows) over the earlier rows of the same ``by``.

    Ranges hold equal numbers of rows whatever the spread of the order values, because rows with equal values are told
    apart by a stored row number; nulls come first. The rows are written to the shared folder twice, as they came and
    by range, so a lost executor changes no number.
    """
    spark, by = df.sparkSession, list(by)
    value = F.lit(1) if value is None else value
    came = materialize(
        df.withColumns({"__row": F.monotonically_increasing_id(), "__value": value.cast("long")}), "unordered")
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(shuffle, -(-came.count() // ROWS_PER_RANGE))
    order = [*order, "__row"]
    ranged = materialize(
        came.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()), "ordered")
    base = (
        ranged.groupBy(*[F.col(c).alias(f"__by{i}") for i, c in enumerate(by)], F.col("__range").alias("__of"))
        .agg(F.sum("__value").alias("__sum"))
    )
    group = [F.col(f"__by{i}") for i in range(len(by))] or [F.lit(0)]
    ahead = W.partitionBy(*group).orderBy("__of").rowsBetween(W.unboundedPreceding, -1)
    base = base.withColumn("__base", F.coalesce(F.sum("__sum").over(ahead), F.lit(0))).drop("__sum")
    same = F.col("__range") == F.col("__of")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__by{i}"))
    inside = W.partitionBy(*by, "__range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.withColumn("__in", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
        .join(base, same)
        .select(*df.columns, (F.col("__base") + F.col("__in")).alias(out))
    )
