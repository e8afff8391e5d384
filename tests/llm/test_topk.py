from __future__ import annotations

import math
import random

import duckdb
import pytest
from fixtures import TABLES
from pyspark.sql import functions as F

from orderweave.llm import topk
from orderweave.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string, rank int, weights int"


def brute(rows, k):
    sound = [(n, i, [math.floor(64 * x) for x in v]) for n, (i, v) in enumerate(rows)
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, q, v in sound:
        if q is None or q % 20:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i) for m, i, w in sound if m != n)
        out += [(q, r + 1, s[3], -s[0]) for r, s in enumerate(scored[:k])]
    return sorted(out, key=str)


def rows_of(spark, rows, **sizes):
    df = spark.createDataFrame([(i, v, 1, "r", "s", 0, 0) for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, 5, **sizes).collect()), key=str)


def cases():
    rng = random.Random(5)
    rows = [(i, [rng.choice([0.0, 0.0, rng.uniform(-1, 1)]) for _ in range(12)]) for i in range(400)]
    rows += [(i, [0.5] * 12) for i in range(400, 700)]  # equal rows: ties by id
    rows += [(700, [0.5] * 12), (700, [0.5] * 12), (None, [0.5] * 12), (None, [9.0]), (720, None), (740, []), (760, [0.0] * 12),
             (780, [1.0, None]), (800, [float("nan")]), (801, [float("inf")]), (820, [0.3] * 20), (-20, [-0.01] * 3)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"block": 64, "queries": 7, "together": 3}])
def test_same_as_brute_force(spark, sizes):
    assert rows_of(spark, cases(), **sizes) == brute(cases(), 5)


def test_few_rows_and_none(spark):
    assert rows_of(spark, []) == [] and rows_of(spark, [(20, [1.0])]) == []
    assert rows_of(spark, [(20, [1.0]), (21, [2.0])]) == [(20, 1, 21, 64 * 128)]


def test_large_components(spark):
    """Beyond what single precision holds, and beyond double precision."""
    for n in (8, 22):
        rows = [(20, [2.0 ** n, 1.0]), (21, [2.0 ** (n + 1), -3.0]), (22, [-(2.0 ** n), 7.0])]
        assert rows_of(spark, rows) == brute(rows, 5)
    with pytest.raises(Exception, match="64 bits"):
        rows_of(spark, [(20, [2.0 ** 40]), (21, [2.0 ** 40])])


def test_query_is_the_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{TABLES}/embeddings.parquet'")
    df = QUERIES["op13_topk_search"](spark, TABLES).select("query_id", "rank", "vec_id", "score")
    want = duckdb.sql(f"SELECT query_id, rank, vec_id, score FROM ({ORACLE['op13_topk_search']})").fetchall()
    assert want and sorted(map(tuple, df.collect())) == sorted(want)
