"""Table schemas and the integer codes stored in them."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

PERSON = T.StructType([
    T.StructField("person_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("balance", MONEY),
])
PRODUCT = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("price", MONEY),
])
INVENTORY = T.StructType([
    T.StructField("inventory_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("qty", T.LongType()),
])
REQUEST = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("person_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("qty", T.LongType()),
    T.StructField("operation", T.IntegerType()),
    T.StructField("result", T.IntegerType()),
])

#: Envelope of a stored record; the Kafka source is renamed to the same columns.
RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition_id", T.IntegerType()),
    T.StructField("offset_id", T.LongType()),
    T.StructField("msg_key", T.StringType()),
    T.StructField("msg_value", T.StringType()),
])

INVENTORY_VIEW = T.StructType([
    T.StructField("inventory_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("qty", T.LongType()),
    T.StructField("product_code", T.StringType()),
    T.StructField("product_description", T.StringType()),
])

# The codes stored in tables and messages.
OPERATION = {"CREDIT": 10, "DEBIT": 20, "REFILL": 30, "ERROR": 99}
RESULT = {"PENDING": 10, "BACK_ORDER": 20, "EXECUTED": 30, "ERROR": 99}
RUN_STATE = {"READY": 10, "EXECUTING": 20, "COMPLETED": 30, "EXCEPTION": 99}

CREDIT, DEBIT = OPERATION["CREDIT"], OPERATION["DEBIT"]
PENDING, BACK_ORDER, EXECUTED, ERROR = (RESULT[k] for k in ("PENDING", "BACK_ORDER", "EXECUTED", "ERROR"))
