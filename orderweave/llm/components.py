"""Connected components of a large graph by alternating stars.

Each round hangs every node's larger neighbours on its smallest one, and then its smaller ones. Smallest neighbours
are combined on the map side and written down before they are joined back, so the rows of a hub that holds a third of
all links can be split by the adaptive skew join. Rounds are logarithmic in the longest path; every round ends in
tables in the shared folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweave.session import materialize


def _smallest(pairs: DataFrame) -> DataFrame:
    return materialize(pairs.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")), "smallest")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = _smallest(both).select("n", F.least("n", "m").alias("m"))
    return (
        both.join(least, both.u == least.n).where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` run from the larger to the smaller node."""
    least = _smallest(edges)
    moved = edges.join(least, edges.u == least.n).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links in the first two columns; component is its smallest node.

    Links to the node itself, repeated and reversed links do no harm, links with a null end count for nothing. A node
    without links is not in the result.
    """
    a, b = edges.columns[:2]
    edges = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct(), "links")
    before = None
    while (now := _mark(edges)) != before:
        before = now
        edges = materialize(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def flatten(label: np.ndarray) -> None:
    """Lets every position's label be the smallest position of its tree."""
    while True:
        short = label[label]
        if np.array_equal(short, label):
            return
        label[:] = short


def join_trees(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Joins, inside one task, the trees of positions u and v; ``label`` starts as the positions themselves."""
    while u.size:
        flatten(label)
        ru, rv = label[u], label[v]
        apart = ru != rv
        u, v, ru, rv = u[apart], v[apart], ru[apart], rv[apart]
        np.minimum.at(label, np.maximum(ru, rv), np.minimum(ru, rv))
