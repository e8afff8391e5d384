"""Shards by jump consistent hashing: a key's shard follows from the key and the number of shards alone.

No ring table is kept. When shards are appended, only rows that move into the new shards move at all. Everything is
built-in SQL functions.

Defined cases: a null key is a key of its own (all such rows share a shard); repeated rows share a shard and get
different slots; a null text has size 1 and checksum 0; an empty table gives no rows; other columns pass
through, and helper columns start with two underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweave.operators.ordering import running_total

#: Fixed values of the published jump hash: the multiplier of its generator, as four 16-bit digits from the lowest.
MULTIPLIER = 2862933555777941757
DIGITS = [(MULTIPLIER >> shift) & 0xFFFF for shift in (0, 16, 32, 48)]
LOW32, LOW16 = 0xFFFFFFFF, 0xFFFF
#: Steps tried before the exact loop over all shards; a key takes about log(shards) + 1 of them.
SHORT_LOOP = 64


def key_bits(column: str, data_type: str) -> Column:
    """The 64 bits that are hashed: integers as they are, anything else by its 64-bit hash."""
    if data_type in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(F.col(column).cast("long"), F.lit(-1).cast("long"))
    return F.xxhash64(column)


def _next_state(state: Column) -> tuple[Column, Column]:
    """(high, low) 32 bits of state * MULTIPLIER + 1 modulo 2**64; no product leaves 64 bits, so ANSI mode is met."""
    hi, lo = state["hi"], state["lo"]
    d0, d1, d2, d3 = (F.lit(d).cast("long") for d in DIGITS)
    p0, p1 = lo * d0, lo * d1
    low = p0.bitwiseAND(F.lit(LOW32)) + F.shiftleft(p1.bitwiseAND(F.lit(LOW16)), 16) + F.lit(1)
    carry = F.shiftright(low, 32) + F.shiftright(p0, 32) + F.shiftright(p1, 16)
    high = (
        carry + lo * d2 + F.shiftleft((lo * d3).bitwiseAND(F.lit(LOW16)), 16)
        + hi * d0 + F.shiftleft((hi * d1).bitwiseAND(F.lit(LOW16)), 16)
    )
    return high.bitwiseAND(F.lit(LOW32)), low.bitwiseAND(F.lit(LOW32))


def _jump(key: Column, shards: int, steps: int) -> Column:
    """(shard, next): ``shard`` is final once ``next`` is not below the number of shards."""
    start = F.struct(
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
        F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(LOW32)).alias("lo"))

    def step(state: Column, _: Column) -> Column:
        hi, lo = _next_state(state)
        ahead = F.floor((state["j"] + 1).cast("double") * (
            F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1).cast("double"))).cast("long")
        moved = F.struct(state["j"].alias("b"), ahead.alias("j"), hi.alias("hi"), lo.alias("lo"))
        return F.when(state["j"] >= shards, state).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 .. shards-1 of a 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard")
    short = _jump(key, shards, min(shards, SHORT_LOOP))
    if shards <= SHORT_LOOP:
        return short["b"].cast("int")
    return F.when(short["j"] >= shards, short["b"]).otherwise(_jump(key, shards, shards)["b"]).cast("int")


def assign_shards(df: DataFrame, key: str, shards: int, out: str = "shard") -> DataFrame:
    """All columns and the shard of each row."""
    return df.withColumn(out, jump_hash(key_bits(key, dict(df.dtypes)[key]), shards))


def slots(df: DataFrame, key: str, shard: str = "shard", out: str = "slot") -> DataFrame:
    """Gapless positions from 0 in each shard, by key. A shard of any size is numbered in ranges, not in one task.

    Rows are moved as they are, so leave wide columns out and join on the slot or the key later.
    """
    return running_total(df, [key], out, by=[shard])


def write_shards(df: DataFrame, key: str, shards: int, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per shard, written by as many tasks as there are; a large shard becomes several files."""
    (
        assign_shards(df, key, shards).write.option("maxRecordsPerFile", rows_per_file)
        .partitionBy("shard").parquet(path)
    )


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard (with one shard more) and slot of every document."""
    key = key_bits("doc_id", dict(docs.dtypes)["doc_id"])
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        jump_hash(key, shards).alias("shard"), jump_hash(key, shards + 1).alias("grown_shard"))
    return slots(narrow, "doc_id")
