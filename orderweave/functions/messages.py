"""Requests as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweave.functions.codes import is_unknown
from orderweave.schemas import OPERATION, RESULT

# Field names of a request message, and the column each one carries.
FIELDS = {
    "requestId": "request_id",
    "personId": "person_id",
    "productId": "product_id",
    "qty": "qty",
    "operation": "operation",
    "result": "result",
}
CORRUPT = "corrupt"
LARGEST_QTY = (1 << 31) - 1
_TYPES = {"operation": "int", "result": "int"}
_SCHEMA = ", ".join(f"{name} {_TYPES.get(name, 'bigint')}" for name in FIELDS) + f", {CORRUPT} string"


def request_to_json() -> Column:
    """The request columns as one JSON object; codes stay integers."""
    return F.to_json(F.struct(*[F.col(column).alias(name) for name, column in FIELDS.items()]))


def with_request(df: DataFrame, value: str = "msg_value") -> DataFrame:
    """Parse ``value`` into request columns plus ``corrupt``.

    Unknown fields are ignored. Whatever cannot be bound leaves the offending text in ``corrupt`` and no fields, so the
    record can be routed away instead of failing the job: broken, null or empty text, a wrong type, no request id, an
    unknown operation or result code, a quantity beyond a 32-bit integer.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.withColumn("__msg", F.from_json(F.col(value), _SCHEMA, options))
    unbound = (
        F.col("__msg").isNull() | F.col("__msg.requestId").isNull()
        | is_unknown(F.col("__msg.operation"), OPERATION) | is_unknown(F.col("__msg.result"), RESULT)
        | F.coalesce(F.abs(F.col("__msg.qty").try_cast("decimal(19,0)")) > LARGEST_QTY, F.lit(False))
    )
    corrupt = F.coalesce(
        F.col(f"__msg.{CORRUPT}"), F.when(unbound, F.coalesce(F.col(value).cast("string"), F.lit(""))))
    judged = parsed.withColumn("__corrupt", corrupt)
    return judged.select(
        *[c for c in df.columns if c not in FIELDS.values()],
        *[F.when(F.col("__corrupt").isNull(), F.col(f"__msg.{name}")).alias(column) for name, column in FIELDS.items()],
        F.col("__corrupt").alias(CORRUPT),
    )
