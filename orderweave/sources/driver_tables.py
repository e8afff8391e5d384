"""The order model derived from the benchmark tables.

``customer`` plays person, ``part`` plays product and ``events`` plays the request stream. Deliberate faults: every
50th product has no inventory, two results in ten are already final, some operations cannot be carried out, some
deliveries come twice and some messages are broken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderweave.functions import messages
from orderweave.operators.filters import eligible_requests
from orderweave.operators.ordering import ordered_index
from orderweave.schemas import MONEY

TOPIC = "requests"
PARTITIONS = 8

#: Schemas seen so far: asking a file for its schema is a job of its own.
_KNOWN_SCHEMAS: dict[str, T.StructType] = {}


class DriverTables:
    """Derived views over one folder of benchmark tables. Everything is lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _KNOWN_SCHEMAS:
            _KNOWN_SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_KNOWN_SCHEMAS[path]).parquet(path)

    def person(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("person_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            (F.col("c_acctbal").cast(MONEY) + F.lit(1000)).cast(MONEY).alias("balance"),
        )

    def product(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.concat_ws("#", "p_name", F.col("p_partkey").cast("string")).alias("code"),
            F.concat_ws(" ", "p_brand", "p_type").alias("description"),
            (F.col("p_size").cast(MONEY) + F.lit(0.99).cast("decimal(3,2)")).cast(MONEY).alias("price"),
        )

    def inventory(self) -> DataFrame:
        return self.raw("part").where(F.col("p_partkey") % 50 != 49).select(
            (F.col("p_partkey") + 1).alias("inventory_id"),
            F.col("p_partkey").alias("product_id"),
            (20 + F.col("p_partkey") % 30).alias("qty"),
        )

    def request(self) -> DataFrame:
        event, digit = F.col("event_id"), F.col("event_id") % 10
        operation = (
            F.when(F.col("event_type").isin("click", "purchase", "view"), 10)
            .when(F.col("event_type") == "signup", 20)
            .when(event % 2 == 0, 99)
            .otherwise(30)
        )
        result = F.when(digit == 7, 20).when(digit == 8, 30).when(digit == 9, 99).otherwise(10)
        return self.raw("events").select(
            event.alias("request_id"),
            F.col("user_id").alias("person_id"),
            F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("product_id"),
            (1 + event % 5).alias("qty"),
            operation.cast("int").alias("operation"),
            result.cast("int").alias("result"),
            "ts",
        )

    def _routed(self) -> DataFrame:
        broken = F.col("request_id") % 101 == 0
        value: Column = F.when(broken, F.lit("{broken")).otherwise(messages.request_to_json())
        routed = eligible_requests(self.request()).select(
            F.lit(TOPIC).alias("topic"),
            (F.col("product_id") % PARTITIONS).cast("int").alias("partition_id"),
            F.col("product_id").cast("string").alias("msg_key"),
            value.alias("msg_value"),
            "request_id",
            "person_id",
            "ts",
        )
        return ordered_index(routed, ["partition_id"], "request_id", "offset_id")

    def record(self) -> DataFrame:
        """The published requests as stored records; one message in 101 is broken."""
        return self._routed().drop("person_id")

    def delivery(self) -> DataFrame:
        """Records as delivered at least once: every 13th comes twice."""
        attempts = F.when(F.col("request_id") % 13 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return self.record().withColumn("attempt", F.explode(attempts))

    def consumer_group(self) -> DataFrame:
        digit = F.col("c_custkey") % 10
        return self.raw("customer").select(
            F.concat(F.lit("group-"), F.col("c_custkey").cast("string")).alias("group_id"),
            F.when(digit == 3, F.lit("SHARE")).when(digit == 5, F.lit(None)).otherwise(F.lit("CONSUMER"))
            .alias("group_type"),
        )

    def threshold(self) -> DataFrame:
        """Lag thresholds; every fourth group has none."""
        key = F.col("c_custkey")
        return self.raw("customer").where(key % 4 != 0).select(
            F.concat(F.lit("group-"), key.cast("string")).alias("group_id"),
            (key % 5 * 10).alias("threshold"),
        )

    def committed(self) -> DataFrame:
        """Each person's group has committed up to its own last record in every partition it touched.

        Every seventh group is ahead of the log end, and every eleventh also holds an offset on a topic without one.
        """
        group = F.concat(F.lit("group-"), F.col("person_id").cast("string")).alias("group_id")
        ahead = F.when(F.col("person_id") % 7 == 0, 100_000).otherwise(0)
        seen = (
            self._routed().groupBy("person_id", "topic", "partition_id")
            .agg((F.max("offset_id") + 1).alias("__next"))
        )
        stray = (
            eligible_requests(self.request()).where(F.col("person_id") % 11 == 0).select("person_id").distinct()
            .select(group, F.lit("audit").alias("topic"), F.lit(0).alias("partition_id"),
                    F.lit(5).cast("long").alias("committed_offset"))
        )
        return seen.select(
            group, "topic", "partition_id", (F.col("__next") + ahead).cast("long").alias("committed_offset")
        ).unionByName(stray)

    def topic_name(self) -> DataFrame:
        """Names of all topics the events mention, internal ones included."""
        kind = F.col("event_id") % 5
        return self.raw("events").select(
            F.when(kind == 0, F.lit("__consumer_offsets"))
            .when(kind == 1, F.concat(F.lit("__transaction_state-"), F.col("event_type")))
            .when(kind == 2, F.lit("_schemas"))
            .when(kind == 3, F.concat(F.lit("orders-"), F.col("event_type")))
            .otherwise(F.concat(F.lit("_audit-"), F.col("event_type"))).alias("topic")
        ).distinct()
