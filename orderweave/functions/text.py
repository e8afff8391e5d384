"""Text, amounts and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(38,10)"


def upper_text(value: Column) -> Column:
    return F.upper(value)


def default_if_blank(value: Column, default: str) -> Column:
    """``default`` for null and for empty text; blanks are kept."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def product_label(code: Column, description: Column) -> Column:
    """Code and description joined by an en dash."""
    return F.concat(code, F.lit(" – "), description)


def parse_amount(raw: Column) -> Column:
    """Text to decimal.

    Dollar signs and all white space (the no-break kinds too) are dropped. Where comma and dot both occur, the
    last one is the decimal mark and the other groups digits; a lone comma is a decimal mark. Anything that is
    not a number after that, including a mark used twice, is null.
    """
    bare = F.regexp_replace(raw, r"(?U)[$\s\uFEFF]", "")
    last_comma = F.length(bare) - F.instr(F.reverse(bare), ",")
    last_dot = F.length(bare) - F.instr(F.reverse(bare), ".")
    both = F.contains(bare, F.lit(",")) & F.contains(bare, F.lit("."))
    plain = (
        F.when(both & (last_comma > last_dot), F.translate(F.translate(bare, ".", ""), ",", "."))
        .when(both, F.translate(bare, ",", ""))
        .otherwise(F.translate(bare, ",", "."))
    )
    return plain.try_cast(AMOUNT)


def epoch_ms_to_string(ms: Column) -> Column:
    """``yyyy/MM/dd HH:mm:ss`` in the session zone, which the jobs keep at UTC."""
    return F.date_format(F.timestamp_millis(ms), "yyyy/MM/dd HH:mm:ss")


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a zone-less UTC time."""
    return F.unix_millis(ts.cast("timestamp"))
