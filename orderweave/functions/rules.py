"""Field rules: each returns a column that is true where the rule is broken."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named test on one field; ``broken`` may be null, which counts as not broken."""

    field: str
    name: str
    broken: Column


def char_required(field: str) -> Rule:
    return Rule(field, "char_required", F.col(field).isNull() | (F.col(field) == ""))


def num_required(field: str) -> Rule:
    return Rule(field, "num_required", F.col(field).isNull())


def integer(field: str) -> Rule:
    value = F.col(field)
    return Rule(field, "integer", value.isNull() | (value != F.floor(value)))


def positive(field: str) -> Rule:
    return Rule(field, "positive", F.col(field).isNull() | (F.col(field) <= 0))


def char_min(field: str, low: int) -> Rule:
    """Empty text passes: being present is another rule."""
    return Rule(field, "char_min", (F.col(field) != "") & (F.length(field) < low))


def char_max(field: str, high: int) -> Rule:
    return Rule(field, "char_max", F.length(field) > high)


def num_min(field: str, low: int | float) -> Rule:
    return Rule(field, "num_min", F.col(field).isNull() | (F.col(field) < low))


def num_max(field: str, high: int | float) -> Rule:
    return Rule(field, "num_max", F.col(field).isNull() | (F.col(field) > high))


def precision(field: str, decimals: int = 2) -> Rule:
    """At most ``decimals`` characters behind the only mark; text with several marks is left to other rules."""
    text = F.trim(F.col(field).cast("string"))
    marks = F.length(text) - F.length(F.translate(text, ".,", ""))
    fraction = F.split_part(F.translate(text, ",", "."), F.lit("."), F.lit(2))
    return Rule(field, "precision", (marks == 1) & (F.length(fraction) > decimals))


def currency(field: str, low: int | None = 0, high: int | None = None, decimals: int = 2) -> list[Rule]:
    """Amount rules in test order; only the first broken one of the list is reported (see :func:`first_of`)."""
    text = F.regexp_replace(F.trim(F.col(field).cast("string")), r"\s", "")
    single = F.regexp_replace(text, "^([^,]*),", "$1.")
    amount = single.try_cast("decimal(38,18)")
    given = F.col(field).isNotNull() & (F.col(field).cast("string") != "")
    digits = F.length(F.rtrim(F.split_part(amount.cast("string"), F.lit("."), F.lit(2)), F.lit("0")))
    found = [
        Rule(field, "currency_invalid", given & amount.isNull()),
        Rule(field, "currency_decimals", given & (digits > decimals)),
    ]
    if low is not None:
        found.append(Rule(field, "currency_min", given & (amount < low)))
    if high is not None:
        found.append(Rule(field, "currency_max", given & (amount > high)))
    return found


def first_of(rules: Sequence[Rule]) -> Rule:
    """One rule that carries the name of the first broken member; used for ordered tests of one field."""
    name = F.lit(None).cast("string")
    for rule in reversed(rules):
        name = F.when(rule.broken, F.lit(rule.name)).otherwise(name)
    return Rule(rules[0].field, "", name)


def violations(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per broken rule: (key, field, rule). One pass over the table, no shuffle."""
    hits = []
    for rule in rules:
        label = rule.broken if rule.name == "" else F.when(rule.broken, F.lit(rule.name))
        hits.append(F.when(label.isNotNull(), F.struct(F.lit(rule.field).alias("field"), label.alias("rule"))))
    return (
        df.select(F.col(key), F.explode(F.array_compact(F.array(*hits))).alias("hit"))
        .select(key, "hit.field", "hit.rule")
    )
