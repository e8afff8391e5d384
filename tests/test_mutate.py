"""Inserts, updates and deletes with constraints against one row after the other."""

from __future__ import annotations

import random

import pytest

from orderweave.operators import mutate

COLUMNS = "seq long, id long, code string, a long, b long"


def serially(stored, new):
    """Row by row: (accepted seqs, status of each)."""
    rows, status = list(stored), {}
    for seq, i, code, a, b in sorted(new):
        if i is None:
            status[seq] = "null_id"
        elif any(r[0] == i for r in stored):
            status[seq] = "duplicate_key"
        elif code is not None and any(r[1] == code for r in stored):
            status[seq] = "duplicate_code"
        elif None not in (a, b) and any(r[2:] == (a, b) for r in stored):
            status[seq] = "duplicate_a_b"
        elif any(r[0] == i or (code is not None and r[1] == code) or (None not in (a, b) and r[2:] == (a, b)) for r in rows):
            status[seq] = "duplicate_in_batch"
        else:
            rows.append((i, code, a, b))
            status[seq] = "accepted"
    return rows, status


def insert(spark, stored, new):
    table = spark.createDataFrame(stored, "id long, code string, a long, b long")
    return mutate.insert_rows(table, spark.createDataFrame(new, COLUMNS), "id", "seq", [], {}, unique=[["code"], ["a", "b"]])


def check(spark, stored, new):
    change = insert(spark, stored, new)
    rows, status = serially(stored, new)
    assert {r.seq: r.status for r in change.judged.collect()} == status
    assert sorted(map(tuple, change.snapshot.collect()), key=str) == sorted(rows, key=str)
    assert {r.status: r.n for r in change.affected().collect()} == {s: list(status.values()).count(s) for s in status.values()}


def test_refused_rows_stand_in_nobodys_way(spark):
    check(spark, [(1, "Z", 0, 0)], [(1, 10, "A", 1, 1), (2, 10, "B", 2, 2), (3, 30, "B", 3, 3)])


def test_long_chain_of_conflicts(spark):
    """Each row meets the one before by its id or its code, so every second one is taken, in as many rounds."""
    new = [(n, (n + 1) // 2, f"c{n // 2}", None, None) for n in range(1, 13)]
    check(spark, [], new)


@pytest.mark.parametrize("seed", range(2))
def test_random_rows(spark, seed):
    rng = random.Random(seed)
    stored = [(n, f"s{n}", n, 0) for n in range(5)]
    pick = lambda *x: rng.choice(x)
    new = [(n, pick(None, *range(40)), pick(None, "s2", *[f"c{i}" for i in range(30)]), pick(None, 1, 7, 8, 9), pick(None, 0, 1, 2, 3))
           for n in range(150)]
    check(spark, stored, new + [(1000 + n, 77, f"hot{n}", None, None) for n in range(60)])


def test_update_looks_at_unique_values(spark):
    table = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, None)], "id long, code string")
    changes = spark.createDataFrame([(1, "A"), (2, "C"), (3, "X"), (4, "X"), (9, "X")], "id long, code string")
    got = {r.id: (r.code, r.status) for r in mutate.update_by_id(table, changes, "id", unique=[["code"]]).collect()}
    assert got == {1: ("A", "updated"), 2: ("B", "duplicate_code"), 3: ("X", "updated"), 4: (None, "duplicate_in_batch"),
                   9: ("X", "not_found")}


def test_delete_gives_the_next_table(spark):
    table, child = spark.createDataFrame([(1,), (2,), (3,)], "id long"), spark.createDataFrame([(2,), (2,)], "id long")
    change = mutate.delete_rows(table, spark.createDataFrame([(1,), (2,), (7,), (7,)], "id long"), "id", [child])
    assert sorted(r.id for r in change.snapshot.collect()) == [2, 3]
    assert {r.status: r.n for r in change.affected().collect()} == {"deleted": 1, "blocked": 1, "not_found": 1}
