"""Row filters on the order tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweave.schemas import BACK_ORDER, PENDING

# Topic names that belong to the broker.
RESERVED_TOPICS = ("__consumer_offsets", "__transaction_state", "_schemas")


def lookup_by_ids(df: DataFrame, key: str, ids: DataFrame | Iterable[int]) -> DataFrame:
    """Rows whose key is in ``ids``: a short list is pushed to the scan, a table is a semi join."""
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).alias(key))
        return df.join(wanted, key, "left_semi")
    return df.where(F.col(key).isin(list(ids)))


def text_contains(df: DataFrame, column: str, part: str) -> DataFrame:
    """Case-sensitive literal substring; ``%`` and ``_`` in ``part`` stand for themselves."""
    return df.where(F.contains(F.col(column), F.lit(part)))


def inventory_by_product(inventory: DataFrame, product_id: int) -> DataFrame:
    return inventory.where(F.col("product_id") == product_id)


def inventory_by_product_code(inventory: DataFrame, product: DataFrame, code: str) -> DataFrame:
    """Inventory rows whose product carries the code; the filter reaches the product scan."""
    return inventory.join(product.where(F.col("code") == code).select("product_id"), "product_id", "left_semi")


def eligible_requests(request: DataFrame) -> DataFrame:
    """Requests still to be processed; a back-ordered one is tried again."""
    return request.where(F.col("result").isin(PENDING, BACK_ORDER))


def user_topics(topics: DataFrame, column: str = "topic") -> DataFrame:
    reserved = reduce(or_, [F.startswith(F.col(column), F.lit(p)) for p in RESERVED_TOPICS])
    return topics.where(~reserved)


def consumer_groups_only(groups: DataFrame) -> DataFrame:
    """Groups of type CONSUMER, and groups without a type."""
    return groups.where(F.coalesce(F.col("group_type") == "CONSUMER", F.lit(True)))
