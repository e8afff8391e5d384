"""Embedding classes against all cosines."""

from __future__ import annotations

import math

import numpy as np
import pytest

from orderweave.llm import hnsw
from test_simhash import classes_of


def brute(rows, threshold):
    sound = {}
    for i, (vec_id, vector, label) in enumerate(rows):
        if vec_id is None or label is None or not vector:
            continue
        if any(v is None or not math.isfinite(v) for v in vector) or not any(vector):
            continue
        sound[i] = np.array(vector, np.float64)
    links, counts = [], {i: 0 for i in range(len(rows))}
    keys = sorted(sound)
    for n, i in enumerate(keys):
        for j in keys[n + 1:]:
            a, b = sound[i], sound[j]
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= threshold:
                counts[i] += 1
                counts[j] += 1
                links.append((rows[i][0], rows[j][0]))
    root = classes_of({r[0] for r in rows if r[0] is not None}, links)
    return sorted(((r[0], counts[i], root.get(r[0]), r[0] is None or root[r[0]] == r[0]) for i, r in enumerate(rows)), key=str)


def made(seed, n, width=16, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    rows = []
    for i in range(n):
        c = rng.integers(12)
        v = centres[c] + rng.normal(size=width) * rng.choice([0.05, 0.2, 1.0])
        rows.append((i, [float(x) for x in np.float32(v)], int(c % labels)))
    return rows


ODD = [(9001, None, 1), (9002, [], 1), (9003, [0.0] * 16, 1), (9004, [1.0] * 15 + [None], 1), (9005, [math.nan] * 16, 1),
       (9006, [math.inf] + [1.0] * 15, 1), (9007, [1.0] * 16, None), (9008, [1.0] * 8, 1), (9009, [2.0] * 8, 1),
       (None, [1.0] * 16, 1), (9010, [1.0] * 16, 1), (9011, [3.0] * 16, 1), (9012, [1.0] * 16, 1), (9012, [1.0] * 16, 1)]
SCHEMA = "vec_id long, embedding array<float>, label int, n_links int, u string"


def result(spark, rows, **options):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in hnsw.embedding_classes(df, 0.93, **options).collect()), key=str)


@pytest.mark.parametrize("shard", [64, 4096])
def test_classes_and_links(spark, shard):
    rows = made(1, 700) + ODD
    assert result(spark, rows, shard=shard) == brute(rows, 0.93)


def test_empty(spark):
    assert result(spark, []) == []


def test_recall_on_a_large_shard():
    """Without widening by an audit, the graph itself finds nearly all."""
    rows = made(2, 2500, 32)
    x = hnsw.unit_rows(np.array([r[1] for r in rows]))
    graph = hnsw.Graph(x)
    exact = x @ x.T >= 0.93
    found = graph.links_of(x, 0.93, hnsw.SEARCH_BEAM)
    assert not (found & ~exact).any()
    assert (found & exact).sum() / exact.sum() >= 0.98


def test_blocks_of_both_directions(monkeypatch):
    rng = np.random.default_rng(3)
    there, back = rng.random((83, 37)) < 0.1, rng.random((37, 83)) < 0.1
    monkeypatch.setattr(hnsw, "CELLS", 300)
    blocks = list(hnsw._either_way(np.packbits(there, axis=1), np.packbits(back, axis=1), 37))
    assert [b for b, _ in blocks] == list(range(0, 83, 8))
    assert np.array_equal(np.concatenate([h for _, h in blocks]), there | back.T)
    one_way = list(hnsw._either_way(np.packbits(there, axis=1), None, 37))
    assert np.array_equal(np.concatenate([h for _, h in one_way]), there)


def test_sparse_queries_are_not_hidden_by_a_hot_group():
    """A thousand links of one group cannot make up for the only links of others."""
    exact = np.zeros((40, 64), bool)
    exact[:20] = True  # the hot group
    exact[range(20, 40), range(20, 40)] = True
    found = exact.copy()
    found[20:40] = False
    assert (found & exact).sum() / exact.sum() > 0.98
    assert hnsw.share_found(np.packbits(found, axis=1), np.packbits(exact, axis=1)) == 0.5
    nothing = np.zeros((5, 8), np.uint8)
    assert hnsw.share_found(nothing, nothing) == 1


def test_audit_goes_on_until_enough_have_links():
    """Links that only a few queries at the end have are looked for all the same."""
    x = hnsw.unit_rows(np.random.default_rng(5).normal(size=(3000, 32)))
    graph = hnsw.Graph(x[:200])
    order = np.arange(2000)
    audited, exact = hnsw.audit(graph, np.concatenate([x[200:1200], x[:40], x[1200:2160]]), order, 0.93)
    assert exact.any(axis=1).sum() >= hnsw.AUDIT_LINKED and 1000 < len(audited) <= 2000
    audited, _ = hnsw.audit(graph, x[200:2200], order, 0.93)
    assert len(audited) == 2000  # none has a link: all have been looked at


def test_the_other_way_is_searched_only_if_the_audit_fails():
    rows = made(7, 1600, 32)
    x = hnsw.unit_rows(np.array([r[1] for r in rows]))
    a, b = hnsw.Graph(x[:800]), x[800:]
    ids = np.arange(800)
    exact = np.packbits(a.x @ b.T >= 0.93, axis=1)
    assert hnsw.met_from(exact, a, b, ids, 0.93)
    assert not hnsw.met_from(np.zeros_like(exact), a, b, ids, 0.93)


def test_several_full_shards_with_a_hot_group():
    """Four shards of one label: recall for links of a group of a third of all vectors, and of sparse pairs apart."""
    rng = np.random.default_rng(11)
    width, n, hot = 32, 3000, 1000
    sparse = rng.normal(size=((n - hot) // 2, width))
    near = sparse + rng.normal(size=sparse.shape) * 0.04
    group = rng.normal(size=width) + rng.normal(size=(hot, width)) * 0.1
    x = hnsw.unit_rows(np.concatenate([sparse, near, group]))[np.random.default_rng(1).permutation(n)]
    shards = np.array_split(np.arange(n), 4)
    graphs = [hnsw.Graph(x[s]) for s in shards]
    exact, found = x @ x.T >= 0.93, np.zeros((n, n), bool)
    for i, a in enumerate(graphs):
        for j in range(i, 4):
            b = graphs[j]
            there = hnsw.search(b, a.x, shards[i], 0.93, own=i == j)
            one_way = i == j or hnsw.met_from(there, a, b.x, shards[j], 0.93)
            back = there if i == j else None if one_way else hnsw.search(a, b.x, shards[j], 0.93)
            for begin, hits in hnsw._either_way(there, back, len(shards[j])):
                at = shards[i][begin:begin + len(hits)]
                found[np.ix_(at, shards[j])] |= hits
                found[np.ix_(shards[j], at)] |= hits.T
    assert not (found & ~exact).any()
    np.fill_diagonal(exact, False)
    many = exact.sum(axis=1)
    for chosen in ((many > 0) & (many < 5), many > 300):
        assert chosen.sum() > 500
        assert (found & exact)[chosen].sum() / exact[chosen].sum() >= 0.95
