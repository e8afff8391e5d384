"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_entities(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table with its declared schema, so nothing is inferred and unused columns are never read."""
    return spark.read.schema(schema).parquet(path)


def scan_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, partitions: int,
              **options: str) -> DataFrame:
    """A database table read in ``partitions`` parallel key ranges. Not tested here: it needs a database."""
    return (
        spark.read.format("jdbc").options(**options)
        .option("url", url).option("dbtable", table)
        .option("partitionColumn", key).option("lowerBound", low).option("upperBound", high)
        .option("numPartitions", partitions).load()
    )
