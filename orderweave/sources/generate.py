"""Generated requests and inventories. Everything random is a function of the row number and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderweave.functions.numbers import mix_id32
from orderweave.operators.ordering import running_total
from orderweave.schemas import CREDIT, INVENTORY, PENDING, PERSON, PRODUCT, REQUEST

# The start data of a fresh installation.
SEED_PERSONS = (
    ("John", "Wick"), ("Jack", "Sparrow"), ("Conan", "Barbarian"), ("Suzan", "Storm"), ("Johnny", "Cash"),
    ("Tony", "Stark"), ("Sophia", "Madria"), ("James", "Bond"), ("Jolene", "Spinoza"), ("Monica", "Spears"),
)
SEED_BALANCE = "2000.00"
SEED_PRODUCTS = (
    ("Apple", "Mcinstosh Apple", "9.99"), ("Banana", "Banana split", "4.99"), ("Steak", "T-Bone Steak 4pack", "49.99"),
    ("Oats", "Quaker Quick Oats", "9.99"), ("Soup", "Campbells chicken soup", "0.99"),
    ("Milk", "Milk 2% - Lactose free", "4.99"), ("Bread", "Multigrain bread", "5.99"),
    ("Juice", "Grapefruit juice", "3.99"), ("Potato", "Bag of potatoes", "4.99"), ("Fish", "Atlantic Cod fish", "29.99"),
)
SEED_STOCK = 100
SEED_GROUPS = 50
SEED_PER_GROUP = 8
SEED_QTY = 10

_WORD = 1 << 32
LOW_STEP, HIGH_STEP, STREAM_STEP = 40503, 2654435, 2654435761


def word(n: Column, stream: int) -> Column:
    """32 bits of row ``n`` for one of several independent draws; rows beyond 2^32 do not repeat the first ones."""
    low = n.bitwiseAND(_WORD - 1) * LOW_STEP
    high = F.shiftright(n, 32) * HIGH_STEP
    return (low + high + F.lit(stream * STREAM_STEP)).bitwiseAND(_WORD - 1)


def draw(word_column: str, count: int) -> Column:
    """A reproducible uniform number 0..count-1 from a word; never null.

    A remainder may be null for the optimizer, so a join on it would be given a test for nulls, and that is pushed down with
    the whole mix written out in place: thousands of terms that no projection shares any more, worked out for each row.
    """
    return F.coalesce(mix_id32(F.col(word_column)) % F.lit(count), F.lit(0).cast("long"))


def _size(df: DataFrame) -> int:
    size = df.count()
    if size <= 0:
        raise ValueError("persons and products are needed first")
    return size


def gen_requests(spark: SparkSession, person: DataFrame, product: DataFrame, n: int, max_qty: int,
                 existing: DataFrame | None = None, replace: bool = False, seed: int = 1) -> DataFrame:
    """``n`` pending CREDIT requests: person and product uniform with replacement, quantity uniform 1..max_qty.

    Appended behind ``existing`` unless ``replace``. Each parent gets a dense position by its id, and the drawn
    position is joined to it, so no parent list travels through the driver.
    """
    if n <= 0 or max_qty <= 0:
        raise ValueError("the number of requests and the largest quantity must be positive")
    persons = running_total(person.select("person_id"), ["person_id"], "p_at")
    products = running_total(product.select("product_id"), ["product_id"], "g_at")
    row = F.col("id")
    words = spark.range(n).select(row, *[word(row, seed + i).alias(f"w{i}") for i in range(3)])
    drawn = words.select(
        row, draw("w0", _size(person)).alias("p_at"), draw("w1", _size(product)).alias("g_at"),
        (draw("w2", max_qty) + 1).alias("qty"),
    )
    first = 0
    if existing is not None and not replace:
        first = existing.agg(F.coalesce(F.max("request_id") + 1, F.lit(0))).first()[0]
    fresh = drawn.join(persons, "p_at").join(products, "g_at").select(
        (row + first).alias("request_id"), "person_id", "product_id", "qty",
        F.lit(CREDIT).alias("operation"), F.lit(PENDING).alias("result"),
    )
    if existing is None or replace:
        return fresh
    return existing.select(*REQUEST.fieldNames()).unionByName(fresh)


def gen_inventory(product: DataFrame, qty: int) -> DataFrame:
    """One inventory row per product with the same quantity."""
    if qty <= 0:
        raise ValueError("the quantity must be positive")
    return product.select(
        (F.col("product_id") + 1).alias("inventory_id"), "product_id", F.lit(qty).cast("long").alias("qty")
    )


def seed_requests(spark: SparkSession, person: DataFrame, product: DataFrame, groups: int,
                  per_group: int = SEED_PER_GROUP, qty: int = SEED_QTY, seed: int = 7) -> DataFrame:
    """``groups`` x ``per_group`` requests; a group shares one random product, each row has its own random person."""
    persons = running_total(person.select("person_id"), ["person_id"], "p_at")
    products = running_total(product.select("product_id"), ["product_id"], "g_at")
    row = F.col("id")
    group = F.expr(f"id div {per_group}")
    words = spark.range(groups * per_group).select(
        row, word(row, seed).alias("w0"), word(group, seed + 1).alias("w1"))
    drawn = words.select(row, draw("w0", _size(person)).alias("p_at"), draw("w1", _size(product)).alias("g_at"))
    return drawn.join(persons, "p_at").join(products, "g_at").select(
        row.alias("request_id"), "person_id", "product_id", F.lit(qty).cast("long").alias("qty"),
        F.lit(CREDIT).alias("operation"), F.lit(PENDING).alias("result"),
    )


def gen_seed_dataset(spark: SparkSession, seed: int = 7) -> dict[str, DataFrame]:
    """The start data: 10 persons, 10 products, stock 100 each and 400 requests."""
    from decimal import Decimal

    person = spark.createDataFrame(
        [(i, *name, Decimal(SEED_BALANCE)) for i, name in enumerate(SEED_PERSONS)], PERSON)
    product = spark.createDataFrame(
        [(i, code, text, Decimal(price)) for i, (code, text, price) in enumerate(SEED_PRODUCTS)], PRODUCT)
    inventory = gen_inventory(product, SEED_STOCK).select(*INVENTORY.fieldNames())
    return {"person": person, "product": product, "inventory": inventory,
            "request": seed_requests(spark, person, product, SEED_GROUPS, seed=seed)}
