"""Exact top-k by inner product: every query against every row, term at a time.

Vectors are sparse rows of whole numbers, floor(scale * x) for each component, zeros left out. Rows are dealt into blocks
of ``BLOCK`` candidates. A block is stored as postings: for each term (dimension) the places that have it and their
weights. A task takes one block of candidates and one block of queries and goes through the queries a few at a time: for
each term it scatters query weight times posting weights into dense arrays of one score per candidate. Every candidate
gets its whole score; nothing is skipped. Each query's best are then selected by partition, and the lists of all blocks are
merged by Spark, which cuts them to k before the shuffle.

The work is queries times rows, as an exhaustive search is. A block of queries goes to each block of candidates once,
so no task holds more than two blocks whatever the size of the table, and no label or copy makes a block larger.

Defined cases: vectors that are null or hold null or non-finite components take no part, neither as query nor as candidate;
an empty vector or one of zeros scores 0 with everything; vectors of different lengths meet in the dimensions both have;
rows that repeat an id are rows of their own, and a query leaves out its own row only; a row without an id is a candidate,
behind the others of its score; components so large that a score could pass 64 bits raise an error; an empty table
gives no rows; other columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderweave.session import materialize

SCALE, K = 64, 20
#: Candidates and queries of one task, and queries scored together.
BLOCK, QUERIES, TOGETHER = 4096, 4096, 16
#: Whole numbers below these are exact in single and double precision.
EXACT_SINGLE, EXACT = 1 << 24, 1 << 53


class Postings:
    """A block of sparse rows by term. ``rows`` are places in the block, in the order the block is given."""

    def __init__(self, lengths: np.ndarray, values: np.ndarray):
        place = np.repeat(np.arange(len(lengths)), lengths)
        starts = np.cumsum(lengths) - lengths
        term = np.arange(len(values)) - np.repeat(starts, lengths)
        some = values != 0
        place, term, values = place[some], term[some], values[some]
        order = np.lexsort((place, term))
        self.size, self.place, self.weight = len(lengths), place[order], values[order]
        self.terms, first = np.unique(term[order], return_index=True)
        self.cuts = np.r_[first, len(order)]

        self.lists = [self._list(a, b) for a, b in zip(self.cuts, self.cuts[1:])]

    def _list(self, a: int, b: int) -> tuple[np.ndarray | None, np.ndarray]:
        """Places and weights of a term; where a quarter of the rows or more have it, a weight for every place and no list."""
        if 4 * (b - a) < self.size:
            return self.place[a:b], self.weight[a:b]
        weight = np.zeros(self.size, self.weight.dtype)
        weight[self.place[a:b]] = self.weight[a:b]
        return None, weight


def scores(postings: Postings, queries: Postings) -> np.ndarray:
    """Scores of all queries (rows) with all places of the block, one term after the other."""
    out = np.zeros((queries.size, postings.size), postings.weight.dtype)
    product = np.empty_like(out)
    _, mine, theirs = np.intersect1d(postings.terms, queries.terms, return_indices=True)
    for i, j in zip(mine, theirs):
        place, weight = postings.lists[i]
        row, query_weight = queries.lists[j]
        if place is None and row is None:
            np.multiply(query_weight[:, None], weight, out=product)
            out += product
        elif place is None:
            out[row] += query_weight[:, None] * weight
        else:
            rows = np.arange(queries.size) if row is None else row
            out[rows[:, None], place] += query_weight[:, None] * weight
    return out


def best(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by place, in order; ``score`` is one query's."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        above = np.flatnonzero(score > least)
        level = np.flatnonzero(score == least)[:k - len(above)]
        found = np.concatenate([above, level])
    else:
        found = np.arange(len(score))
    return found[np.lexsort((found, -score[found]))]


def _sparse(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return (lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64),
            lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.min())), abs(int(values.max()))) if len(values) else 0


def _match(k: int, together: int):
    def run(key, queries: pa.Table, rows: pa.Table) -> pa.Table:
        out_schema = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not len(queries) or not len(rows):
            return out_schema.empty_table()
        # ids in order, rows without one behind: equal scores then go by place
        rows = rows.take(pc.sort_indices(rows, [("vec_id", "ascending"), ("row", "ascending")]))
        lengths, values = _sparse(rows.column("weights"))
        asked, wanted = _sparse(queries.column("weights"))
        bound = _largest(values) * _largest(wanted) * max(1, min(int(lengths.max()), int(asked.max())))
        if bound >= 1 << 63:
            raise OverflowError("a score could pass 64 bits")
        kind = np.float32 if bound < EXACT_SINGLE else np.float64 if bound < EXACT else np.int64
        postings = Postings(lengths, values.astype(kind))
        own, query_rows = rows.column("row").to_numpy(), queries.column("row").to_numpy()
        by_row = np.argsort(own)
        at = np.searchsorted(own, query_rows, sorter=by_row).clip(max=len(own) - 1)
        at = np.where(own[by_row[at]] == query_rows, by_row[at], -1)
        ends = np.r_[0, np.cumsum(asked)]
        places, points, number = [], [], []
        for begin in range(0, len(asked), together):
            end = min(begin + together, len(asked))
            table = scores(postings, Postings(asked[begin:end], wanted[ends[begin]:ends[end]].astype(kind)))
            for q in range(begin, end):
                score = table[q - begin]
                chosen = best(score, k + 1 if at[q] >= 0 else k)
                chosen = chosen[chosen != at[q]][:k]
                places.append(chosen)
                points.append(score[chosen].astype(np.int64))
                number.append(np.full(len(chosen), q))
        chosen, q = pa.array(np.concatenate(places)), pa.array(np.concatenate(number))
        return pa.Table.from_arrays(
            [queries.column("row").take(q), queries.column("vec_id").take(q), rows.column("vec_id").take(chosen),
             pa.array(np.concatenate(points), pa.int64())], schema=out_schema)

    return run


def sparse_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """row, vec_id and weights of every vector that takes part; written down, as the row numbers tell rows apart."""
    x = F.col("embedding").cast("array<double>")
    sound = F.col("embedding").isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    weights = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    return materialize(vectors.where(sound).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        weights.alias("weights")), "sparse-rows")


def _dealt(rows: DataFrame, name: str, blocks: int) -> DataFrame:
    return rows.withColumn(name, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, block: int = BLOCK,
          queries: int = QUERIES, together: int = TOGETHER) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest inner products for each row that ``is_query`` chooses.

    ``is_query`` is a condition on vec_id.
    """
    rows = sparse_rows(vectors, scale)
    asked = rows.where(is_query)
    n_blocks, n_asked = max(1, math.ceil(rows.count() / block)), max(1, math.ceil(asked.count() / queries))
    every = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    asked = _dealt(asked, "asked", n_asked).withColumn("block", every)
    # a block of candidates meets each block of queries
    dealt = _dealt(rows, "block", n_blocks).withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))))
    match = _match(k, together)
    found = asked.groupBy("block", "asked").cogroup(dealt.groupBy("block", "asked")).applyInArrow(
        lambda key, left, right: match(key, left, right), "query long, query_id long, vec_id long, score long")
    order = W.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
