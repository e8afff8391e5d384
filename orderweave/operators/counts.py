"""Counts and run statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweave.schemas import BACK_ORDER, ERROR, EXECUTED, PENDING, RUN_STATE


def count_entities(**tables: DataFrame) -> DataFrame:
    """(entity, rows) for each table."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("entity"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def request_count(request: DataFrame, *more: Column) -> DataFrame:
    """One row of status counts; an empty table gives nulls, as a SQL sum does. ``more`` joins the same pass."""
    def tally(test: Column, name: str) -> Column:
        return F.sum(F.when(test, 1).otherwise(0)).alias(name)

    result = F.col("result")
    return request.agg(
        tally(result == PENDING, "nbr_pending"),
        tally(result == BACK_ORDER, "nbr_back_order"),
        tally(result == EXECUTED, "nbr_executed"),
        tally(result == ERROR, "nbr_error"),
        tally(result.isNull() | ~result.isin(PENDING, BACK_ORDER, EXECUTED, ERROR), "nbr_unknown"),
        *more,
    )


def with_run_state(counts: DataFrame) -> DataFrame:
    """The state that published, processed and failed counts imply."""
    done = F.col("nbr_published") == F.col("nbr_processed") + F.col("nbr_processed_with_error")
    state = (
        F.when(~done, RUN_STATE["EXECUTING"])
        .when(F.col("nbr_processed_with_error") == 0, RUN_STATE["COMPLETED"])
        .otherwise(RUN_STATE["EXCEPTION"])
    )
    return counts.withColumn("run_state", state)


def run_stats(published: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Published, processed and failed counts of a run and the state they imply.

    ``outcomes`` has one row per handled record with a boolean ``failed`` (dead-lettered). An empty run is complete.
    """
    handled = F.struct(F.lit(0).alias("sent"), (~F.col("failed")).cast("int").alias("ok"),
                       F.col("failed").cast("int").alias("bad"))
    sent = F.struct(F.lit(1).alias("sent"), F.lit(0).alias("ok"), F.lit(0).alias("bad"))
    marks = published.select(sent.alias("m")).unionByName(outcomes.select(handled.alias("m")))
    total = {"nbr_published": "sent", "nbr_processed": "ok", "nbr_processed_with_error": "bad"}
    return with_run_state(
        marks.agg(*[F.coalesce(F.sum(f"m.{part}"), F.lit(0)).alias(name) for name, part in total.items()])
    )
