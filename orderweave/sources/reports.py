"""The inventory report as JSON, XML and CSV."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderweave.schemas import INVENTORY_VIEW

# Default texts of a report, its formats and its date pattern.
TITLE = "Inventory report"
SUB_TITLE = "Control and corroboration"
DATE_PATTERN = "yyyy-MM-dd HH:mm:ss"


def header(spark: SparkSession, title: str | None = None, sub_title: str | None = None) -> DataFrame:
    return spark.range(1).select(F.lit(title or TITLE).alias("title"), F.lit(sub_title or SUB_TITLE).alias("sub-title"))


def footer(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.date_format(F.current_timestamp(), DATE_PATTERN).alias("date"))


def _write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def _write_xml(df: DataFrame, path: str) -> None:
    df.write.format("xml").option("rootTag", "report").option("rowTag", "row").save(path)


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


_WRITERS: dict[str, Callable[[DataFrame, str], None]] = {"json": _write_json, "xml": _write_xml, "csv": _write_csv}


def write_report(view: DataFrame, path: str, media: str, title: str | None = None,
                 sub_title: str | None = None) -> None:
    """Header, body and footer as three folders below ``path``; the body is written by all tasks in parallel."""
    if media not in _WRITERS:
        raise ValueError(f"a report is one of {sorted(_WRITERS)}")
    spark, write = view.sparkSession, _WRITERS[media]
    write(header(spark, title, sub_title), f"{path}/header")
    write(view.select(*INVENTORY_VIEW.fieldNames()), f"{path}/body")
    write(footer(spark), f"{path}/footer")


def read_report(spark: SparkSession, path: str, media: str) -> DataFrame:
    """The body of a written report."""
    reader = spark.read.schema(INVENTORY_VIEW)
    body = f"{path}/body"
    if media == "xml":
        return reader.format("xml").option("rowTag", "row").load(body)
    return reader.json(body) if media == "json" else reader.option("header", True).csv(body)
