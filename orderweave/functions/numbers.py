"""Costs, offsets and the reversible id mix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COST = "decimal(18,2)"
LARGEST_COST = "9999999999999999.99"

# The half-word that absorbs first, its left shift, and the right shift that answers it.
MIX_STEPS = (("high", 6, 11), ("high", 2, 4), ("low", 5, 1), ("low", 3, 6))
_HALF = 0xFFFF


def request_cost(price: Column, qty: Column) -> Column:
    """Exact price times quantity; above what the type can hold, the largest cost, which no balance covers."""
    exact = (price * qty.cast("decimal(19,0)")).try_cast(COST)
    known = price.isNotNull() & qty.isNotNull()
    return F.coalesce(exact, F.when(known, F.lit(LARGEST_COST).cast(COST)))


def clamped_lag(end: Column, committed: Column) -> Column:
    return F.greatest(end - committed, F.lit(0).cast("long"))


def clamped_seek(requested: Column, end: Column) -> Column:
    return F.least(requested, end)


def _split(value: Column) -> dict[str, Column]:
    return {"high": F.shiftright(value, 16).bitwiseAND(_HALF), "low": value.bitwiseAND(_HALF)}


def _join(value: Column, half: dict[str, Column]) -> Column:
    """The low 32 bits from the halves; bits above them stay as they are in ``value``."""
    low = F.shiftleft(half["high"], 16).bitwiseOR(half["low"])
    return F.shiftleft(F.shiftright(value, 32), 32).bitwiseOR(low)


def _absorb(half: dict[str, Column], side: str, left: int, right: int) -> dict[str, Column]:
    other = "low" if side == "high" else "high"
    grown = (half[side] + F.shiftleft(half[other], left)).bitwiseAND(_HALF)
    return {side: grown, other: half[other].bitwiseXOR(F.shiftright(grown, right))}


def _release(half: dict[str, Column], side: str, left: int, right: int) -> dict[str, Column]:
    other = "low" if side == "high" else "high"
    back = half[other].bitwiseXOR(F.shiftright(half[side], right))
    return {side: (half[side] - F.shiftleft(back, left)).bitwiseAND(_HALF), other: back}


def mix_id32(value: Column) -> Column:
    """Bijective mix of the low 32 bits of an id: masks ids reversibly and gives a stable shuffled order.

    Higher bits are kept, so ids beyond 32 bits never meet.
    """
    value = value.cast("long")
    half = _split(value)
    for side, left, right in MIX_STEPS:
        half = _absorb(half, side, left, right)
    return _join(value, half)


def unmix_id32(value: Column) -> Column:
    """Inverse of :func:`mix_id32`."""
    value = value.cast("long")
    half = _split(value)
    for side, left, right in reversed(MIX_STEPS):
        half = _release(half, side, left, right)
    return _join(value, half)
