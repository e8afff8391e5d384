"""Allocation against a plain serial fold."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderweave import schemas as S
from orderweave.operators import allocate as A
from orderweave.session import materialize


def serial(requests, inventory, product, person):
    """The rules, one request after the other: {request_id: (result, reason, stock met, balance met)}."""
    stock = {p: q for _, p, q in inventory}
    price = {r[0]: r[3] for r in product}
    balance = {r[0]: r[3] for r in person}
    out = {}
    for rid, who, what, qty, operation, result in sorted(requests):
        if result not in (10, 20):
            out[rid] = (result, None, None, None)
        elif what not in stock or what not in price or who not in balance or operation not in (10, 20):
            out[rid] = (99, None, None, None)
        else:
            cost, s, b = price[what] * qty, stock[what], balance[who]
            if operation == 10 and s < qty:
                out[rid] = (20, "stock", s, b)
            elif operation == 10 and b < cost:
                out[rid] = (20, "balance", s, b)
            else:
                sign = -1 if operation == 10 else 1
                stock[what] += sign * qty
                balance[who] += sign * cost
                out[rid] = (30, None, s, b)
    return out, stock, balance


def frames(spark, requests, inventory, product, person):
    return (spark.createDataFrame(requests, S.REQUEST), spark.createDataFrame(inventory, S.INVENTORY),
            spark.createDataFrame(product, S.PRODUCT), spark.createDataFrame(person, S.PERSON))


def decided(df):
    return {r.request_id: (r.result, r.reason, r.stock_before, r.balance_before) for r in df.collect()}


def parents(stock, balance, prices=None):
    product = [(i, f"c{i}", f"d{i}", Decimal((prices or {}).get(i, "1.00"))) for i in stock]
    return ([(i + 100, i, q) for i, q in stock.items()], product,
            [(i, f"f{i}", f"l{i}", Decimal(b)) for i, b in balance.items()])


def check(spark, requests, tables, chunk_rows=A.CHUNK_ROWS):
    expected, stock, balance = serial(requests, *tables)
    request, inventory, product, person = frames(spark, requests, *tables)
    result = A.allocate_requests(request, inventory, product, person, chunk_rows)
    assert decided(result) == expected
    after = {r.product_id: r.qty for r in A.next_inventory(inventory, result).collect()}
    assert after == stock
    money = {r.person_id: r.balance for r in A.next_person(person, result).collect()}
    assert money == balance
    return expected


HAND_MADE = {
    "equal amounts pass": ([(1, 1, 1, 5, 10, 10)], {1: 5}, {1: "5.00"}, {1: (30, None, 5, Decimal(5))}),
    "both short is stock": ([(1, 1, 1, 6, 10, 10)], {1: 5}, {1: "1.00"}, {1: (20, "stock", 5, Decimal(1))}),
    "debit in between": (
        [(1, 1, 1, 6, 10, 10), (2, 1, 1, 1, 20, 10), (3, 1, 1, 6, 10, 20)], {1: 5}, {1: "9.00"},
        {1: (20, "stock", 5, Decimal(9)), 2: (30, None, 5, Decimal(9)), 3: (30, None, 6, Decimal(10))}),
    "small one after a large one": (
        [(1, 1, 1, 6, 10, 10), (2, 1, 1, 2, 10, 10)], {1: 5}, {1: "9.00"},
        {1: (20, "stock", 5, Decimal(9)), 2: (30, None, 5, Decimal(9))}),
    "a balance failure leaves the stock": (
        [(1, 1, 1, 5, 10, 10), (2, 2, 1, 5, 10, 10)], {1: 5}, {1: "1.00", 2: "9.00"},
        {1: (20, "balance", 5, Decimal(1)), 2: (30, None, 5, Decimal(9))}),
    "missing parents and other operations": (
        [(1, 9, 1, 1, 10, 10), (2, 1, 9, 1, 10, 10), (3, 1, 1, 1, 30, 10), (4, 1, 1, 1, 99, 10)], {1: 5}, {1: "9.00"},
        {n: (99, None, None, None) for n in (1, 2, 3, 4)}),
    "final results stay": (
        [(1, 1, 1, 1, 10, 30), (2, 1, 1, 1, 10, 99)], {1: 5}, {1: "9.00"},
        {1: (30, None, None, None), 2: (99, None, None, None)}),
    "negative credit adds": (
        [(1, 1, 1, -3, 10, 10), (2, 1, 1, 8, 10, 10)], {1: 5}, {1: "9.00"},
        {1: (30, None, 5, Decimal(9)), 2: (30, None, 8, Decimal(12))}),
}


def test_hand_made(spark):
    """All cases in one run: each has its own products, persons and request ids."""
    requests, stock, balance, expected = [], {}, {}, {}
    for n, (case_requests, case_stock, case_balance, case_expected) in enumerate(HAND_MADE.values()):
        base = n * 100
        requests += [(r + base, who + base, what + base, *rest) for r, who, what, *rest in case_requests]
        stock |= {k + base: v for k, v in case_stock.items()}
        balance |= {k + base: v for k, v in case_balance.items()}
        expected |= {k + base: v for k, v in case_expected.items()}
    assert check(spark, requests, parents(stock, balance)) == expected


def skewed(seed, n):
    """One product and one person hold a third of the rows each."""
    rnd = random.Random(seed)

    def key(n):
        return 0 if rnd.random() < 1 / 3 else rnd.randrange(n)

    requests = [(i, key(9), key(7), rnd.randint(1, 9), rnd.choice((10, 10, 10, 20)), rnd.choice((10, 10, 20, 30)))
                for i in range(n)]
    return requests, parents(
        {i: rnd.randint(0, 300) for i in range(6)}, {i: f"{rnd.randint(0, 900)}.50" for i in range(9)},
        {i: f"{i + 1}.25" for i in range(6)})


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_keys_cut_into_many_chunks(spark, seed):
    requests, tables = skewed(seed, 900)
    results = check(spark, requests, tables, chunk_rows=150)
    assert {"stock", "balance"} <= {r[1] for r in results.values()}


@pytest.mark.parametrize("windows", [False, True])
def test_rounds_and_windows_agree_with_the_fold(spark, monkeypatch, windows):
    """The same closely coupled requests, once by rounds to the end and once finished in windows."""
    used = []
    finish = A._in_windows
    monkeypatch.setattr(A, "_in_windows", lambda *a: used.append(a[3]) or finish(*a))
    monkeypatch.setattr(A, "PATIENCE", 1 if windows else 10**6)
    requests, tables = skewed(3, 600)
    check(spark, requests, tables, chunk_rows=200)
    assert bool(used) == windows


def test_stock_only_in_small_chunks_equals_one_chunk(spark, tables):
    args = tables.request().drop("ts"), tables.inventory(), tables.product(), tables.person()
    small, large = (
        {r.request_id: tuple(r) for r in A.allocate_stock_only(*args, chunk_rows=n).collect()} for n in (60, 500_000))
    assert small == large


def test_a_hot_key_is_cut_into_chunks_of_even_size(spark):
    requests, tables = skewed(5, 4000)
    rows = A._price(*frames(spark, requests, *tables)).where("runs")
    placed = materialize(A._lay_out(A._lay_out(rows, A.STOCK, 10), A.BALANCE, 10), "placed")
    for side in (A.STOCK, A.BALANCE):
        sizes = [r["count"] for r in placed.groupBy(side.chunk).count().collect()]
        assert max(sizes) < 2 * sum(sizes) / len(sizes)
        assert placed.where(F.col(side.key) == 0).select(side.chunk).distinct().count() >= 3


def test_walks_read_the_bucketed_layout_without_a_shuffle(spark, tables):
    request, inventory, product, person = tables.request(), tables.inventory(), tables.product(), tables.person()
    rows = A._price(request, inventory, product, person).where("runs")
    placed = A._lay_out(A._lay_out(rows, A.STOCK, 4), A.BALANCE, 4)
    layout = A._Layout(placed, A.STOCK, A.BALANCE, 4)
    plan = layout._with_notes(layout._notes(None, False)).applyInPandas(
        A._round_task(A.STOCK, A.BALANCE), A._WALKED)._jdf.queryExecution().executedPlan().toString()
    layout.drop()
    rows_side = plan[:plan.index("LocalTableScan")] if "LocalTableScan" in plan else plan
    assert "Bucketed: true" in plan
    assert plan.count("Exchange") <= 1, rows_side


def test_empty_input(spark):
    inventory, product, person = parents({1: 5}, {1: "9.00"})
    request, *rest = frames(spark, [], inventory, product, person)
    assert A.allocate_requests(request, *rest).count() == 0


def test_ranges_are_drawn_from_written_rows(tables, monkeypatch):
    """Each range partitioning runs its input once more for the bounds: no join may be left in it."""
    plans = {}

    def noted(df, label, *rest):
        plans.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString())
        return materialize(df, label, *rest)

    monkeypatch.setattr(A, "materialize", noted)
    inputs = tables.request(), tables.inventory(), tables.product(), tables.person()
    for decide in (A.allocate_requests, A.allocate_stock_only):
        plans.clear()
        decide(*inputs)
        assert "RepartitionByExpression" in plans["priced"] and "Join" not in plans["priced"]
