"""Column functions on hand-made values."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderweave import schemas as S
from orderweave.functions import codes, messages, numbers, rules, text


def column(spark, values, kind, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


AMOUNTS = {
    "1.250,50": "1250.50", "1,250.50": "1250.50", "$ 12,5": "12.5", "abc": None, "": None, None: None, "1,2,3": None,
    "1.2.3": None, "1.250,5,0": None, "1,250,300.5": "1250300.5", "12 $": "12", "1 234,5": "1234.5", "-7": "-7",
    "1 234,5": "1234.5", "NaN": None, "Infinity": None, " 5 ": "5",
}


def test_parse_amount(spark):
    got = column(spark, list(AMOUNTS), "string", text.parse_amount)
    assert got == [None if v is None else Decimal(v) for v in AMOUNTS.values()]


def test_codes(spark):
    values = [10, 20, 30, 99, 7, None]
    assert column(spark, values, "int", lambda c: codes.decode(c, S.OPERATION)) == [
        "CREDIT", "DEBIT", "REFILL", "ERROR", None, None]
    assert column(spark, values, "int", lambda c: codes.is_unknown(c, S.OPERATION)) == [False] * 4 + [True, False]
    assert column(spark, ["CREDIT", "x", None], "string", lambda c: codes.encode(c, S.OPERATION)) == [10, None, None]


def test_default_and_label(spark):
    assert column(spark, ["", None, " ", "a"], "string", lambda c: text.default_if_blank(c, "d")) == ["d", "d", " ", "a"]
    assert column(spark, ["c"], "string", lambda c: text.product_label(c, F.lit("d"))) == ["c – d"]


def test_time(spark):
    assert column(spark, [0, 1704067798779], "long", text.epoch_ms_to_string) == [
        "1970/01/01 00:00:00", "2024/01/01 00:09:58"]


def test_mix_is_reversible_and_spreads(spark):
    rnd = random.Random(4)
    values = [0, 1, 2**32 - 1, 2**31] + [rnd.randrange(2**32) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", numbers.mix_id32(F.col("v")).alias("m"))
    rows = df.select("v", "m", numbers.unmix_id32(F.col("m")).alias("back")).collect()
    assert all(r.v == r.back and 0 <= r.m < 2**32 for r in rows)
    assert len({r.m for r in rows}) == len(set(values))


def test_cost_and_clamps(spark):
    df = spark.createDataFrame([(Decimal("49.99"), 3, 10, 4)], "p decimal(10,2), q long, a long, b long")
    row = df.select(numbers.request_cost(F.col("p"), F.col("q")).alias("cost"),
                    numbers.clamped_lag(F.col("a"), F.col("b")).alias("lag"),
                    numbers.clamped_lag(F.col("b"), F.col("a")).alias("none"),
                    numbers.clamped_seek(F.col("a"), F.col("b")).alias("seek")).first()
    assert tuple(row) == (Decimal("149.97"), 6, 0, 4)


def test_json_both_ways(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 10, 20)], S.REQUEST)
    payload = df.select(messages.request_to_json().alias("msg_value"))
    assert payload.first()[0] == '{"requestId":1,"personId":2,"productId":3,"qty":4,"operation":10,"result":20}'
    back = messages.with_request(payload).first()
    assert (back.request_id, back.result, back.corrupt) == (1, 20, None)
    bad = spark.createDataFrame([('{"requestId":"x"}',), ("{",), ("",)], "msg_value string")
    assert [r.corrupt is not None for r in messages.with_request(bad).collect()][:2] == [True, True]


RULES = {
    "": ["char_required"], None: ["char_required"], "ab": ["char_min"], "abcdef": ["char_max"], "abc": [],
}


@pytest.mark.parametrize("value", RULES)
def test_text_rules(spark, value):
    df = spark.createDataFrame([(1, value)], "id int, t string")
    found = rules.violations(df, "id", [rules.char_required("t"), rules.char_min("t", 3), rules.char_max("t", 5)])
    assert [r.rule for r in found.collect()] == RULES[value]


CURRENCY = {
    "1.50": None, "1,50": None, "1.500": None, "1.505": "currency_decimals", "x": "currency_invalid", "": None,
    None: None, "-1": "currency_min", "101": "currency_max", "1 00": None, "1,5,0": "currency_invalid", "1e1": None,
}


def test_currency(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(CURRENCY)], "id int, t string")
    found = rules.violations(df, "id", [rules.first_of(rules.currency("t", low=0, high=100))]).collect()
    assert {r.id: r.rule for r in found} == {i: r for i, r in enumerate(CURRENCY.values()) if r}


def test_precision_and_numbers(spark):
    df = spark.createDataFrame([(1, "1.234", 1.5), (2, "1.23", 2.0), (3, "1.2.345", None), (4, None, -1.0)],
                               "id int, t string, n double")
    found = rules.violations(df, "id", [
        rules.precision("t"), rules.integer("n"), rules.positive("n"), rules.num_min("n", 0), rules.num_max("n", 1.9),
        rules.num_required("n")]).collect()
    assert {(r.id, r.rule) for r in found} == {
        (1, "precision"), (1, "integer"), (2, "num_max"), (3, "integer"), (3, "positive"), (3, "num_min"),
        (3, "num_max"), (3, "num_required"), (4, "positive"), (4, "num_min")}
