"""Joined views, enrichment and paging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderweave.functions.numbers import request_cost
from orderweave.operators.ordering import ROWS_PER_RANGE
from orderweave.session import materialize, scratch, small_side

REQUEST_PAGE_SIZES = (5, 50, 100, -1)
INVENTORY_PAGE_SIZES = (5, 10, 15, -1)


def inventory_view(inventory: DataFrame, product: DataFrame) -> DataFrame:
    """Inventory with the code and description of its product. Join keys are unique on both sides."""
    return inventory.join(product, "product_id").select(
        "inventory_id", "product_id", "qty",
        F.col("code").alias("product_code"), F.col("description").alias("product_description"),
    )


def inventory_view_by_id(inventory: DataFrame, product: DataFrame, inventory_id: int) -> DataFrame:
    return inventory_view(inventory.where(F.col("inventory_id") == inventory_id), product)


def request_view(request: DataFrame, person: DataFrame, product: DataFrame) -> DataFrame:
    """Requests with the names of their person and product.

    Both parents are unique on the key, so a hot key only ever grows the request side, which AQE splits; parents
    below the broadcast threshold need no shuffle at all.
    """
    return (
        request.join(person.drop("balance"), "person_id").join(product.drop("price"), "product_id")
        .select(
            "request_id", "person_id",
            F.col("first_name").alias("person_first_name"), F.col("last_name").alias("person_last_name"),
            "product_id", F.col("code").alias("product_code"), F.col("description").alias("product_description"),
            "qty", "operation", "result",
        )
    )


def request_view_by_id(request: DataFrame, person: DataFrame, product: DataFrame, request_id: int) -> DataFrame:
    return request_view(request.where(F.col("request_id") == request_id), person, product)


def enrich_requests(request: DataFrame, inventory: DataFrame, product: DataFrame, person: DataFrame) -> DataFrame:
    """Attach stock, price, balance and cost; ``parents_found`` is false when any of the three is missing.

    Stock and price share the product key and are joined first, so the request side is moved once per key. That
    small join is written down: read back it needs an exchange of its own, and only between two exchanges can AQE
    split a hot product.
    """
    goods = materialize(product.select("product_id", "price").join(
        inventory.select("product_id", "inventory_id", F.col("qty").alias("stock")), "product_id"
    ), "goods")
    return (
        request.join(goods, "product_id", "left")
        .join(person.select("person_id", "balance"), "person_id", "left")
        .withColumn("parents_found", F.col("price").isNotNull() & F.col("balance").isNotNull())
        .withColumn("cost", F.when(F.col("parents_found"), request_cost(F.col("price"), F.col("qty"))))
    )


def page(df: DataFrame, order: str, key: str, number: int, size: int, descending: bool = False) -> DataFrame:
    """Page ``number`` (from 0) of ``df`` sorted on any column; the key breaks ties. Size -1 is everything.

    The rows are put into ranges of the order and the ranges are counted, so the rank of a range's first row is known. Only the
    ranges that hold the page are sorted, whatever the page number; no task gathers the rows before the page. Rows that
    are equal in order and key are told apart by a stored row number.
    """
    first = F.col(order).desc() if descending else F.col(order).asc()
    if size < 0:
        return df.orderBy(first, F.col(key))
    spark = df.sparkSession
    came = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "page-rows")
    sorting = [first, F.col(key), F.col("__row")]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-came.count() // ROWS_PER_RANGE))
    path = scratch(spark, "page-ranges")
    # the number of a range is fixed by writing it, and reading one range reads its folder only
    came.repartitionByRange(ranges, *sorting).withColumn("__range", F.spark_partition_id()).write.partitionBy(
        "__range").parquet(path)
    layout = T.StructType([*came.schema.fields, T.StructField("__range", T.IntegerType())])
    ranged = spark.read.schema(layout).parquet(path)
    begin, end = number * size, (number + 1) * size
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    bases = (
        ranged.groupBy("__range").agg(F.count("*").alias("__n"))  # one row for each range
        .withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .where((F.col("__base") < end) & (F.col("__base") + F.col("__n") > begin))
    )
    held = ranged.join(small_side(bases, "page-bases"), "__range")
    inside = W.partitionBy("__range").orderBy(*sorting)
    rank = F.col("__base") + F.row_number().over(inside) - 1
    return (
        held.withColumn("__rank", rank).where((F.col("__rank") >= begin) & (F.col("__rank") < end))
        .orderBy("__rank").select(*df.columns)
    )


def page_after(df: DataFrame, order: str, key: str, size: int, last: tuple | None = None,
               descending: bool = False) -> DataFrame:
    """The next ``size`` rows behind ``last``, the (order value, key) of the last row seen; None begins.

    Unlike a page number, this costs the same for the millionth page as for the first: each task keeps ``size`` rows.
    ``order`` is not null.
    """
    first = F.col(order).desc() if descending else F.col(order).asc()
    if last is not None:
        value, seen = (F.lit(v) for v in last)
        beyond = F.col(order) < value if descending else F.col(order) > value
        df = df.where(beyond | ((F.col(order) == value) & (F.col(key) > seen)))
    return df.orderBy(first, F.col(key)).limit(size)


def page_requests(view: DataFrame, order: str, number: int = 0, size: int = 5, descending: bool = False) -> DataFrame:
    if size not in REQUEST_PAGE_SIZES:
        raise ValueError(f"page size must be one of {REQUEST_PAGE_SIZES}")
    return page(view, order, "request_id", number, size, descending)


def page_inventories(view: DataFrame, order: str, number: int = 0, size: int = 5,
                     descending: bool = False) -> DataFrame:
    if size not in INVENTORY_PAGE_SIZES:
        raise ValueError(f"page size must be one of {INVENTORY_PAGE_SIZES}")
    return page(view, order, "inventory_id", number, size, descending)
