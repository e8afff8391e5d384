"""Codes to names and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode(code: Column, names: dict[str, int]) -> Column:
    """Name of an integer code; null for null and for a code that is not in the list."""
    chain = F.lit(None).cast("string")
    for name, value in names.items():
        chain = F.when(code == value, F.lit(name)).otherwise(chain)
    return chain


def encode(name: Column, names: dict[str, int]) -> Column:
    """Integer code of a name; null for null and for an unknown name."""
    chain = F.lit(None).cast("int")
    for known, value in names.items():
        chain = F.when(name == known, F.lit(value)).otherwise(chain)
    return chain


def is_unknown(code: Column, names: dict[str, int]) -> Column:
    """True for a code that must be rejected; a null code is not unknown."""
    return F.coalesce(~code.isin(*names.values()), F.lit(False))
