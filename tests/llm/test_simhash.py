"""Fingerprints and classes against all pairs."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from fixtures import empty, frame, stored, texts
from orderweave.llm import simhash
from orderweave.llm.components import components


def plain_fingerprint(text, words=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(parts[i:i + words]) for i in range(max(len(parts) - words + 1, 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_triples_cover_every_four_positions():
    assert len(simhash.TRIPLES) == 20
    for four in combinations(range(8), 4):
        assert any(set(t) <= set(four) for t in simhash.TRIPLES)


def test_fingerprints():
    samples = [t for _, t in texts()] + [t for _, t in stored("documents", "doc_id, text")[:60]] + [
        "A B \x1c c\x0bd É", "\x1f"]
    for text in samples:
        assert simhash.fingerprint(text, 4) == plain_fingerprint(text)


def test_native_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    h = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    assert h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_classes(spark):
    rows = texts() + stored("documents", "doc_id + 1000, text")
    prints = [plain_fingerprint(t) for _, t in rows]
    links = [(a, b) for a, b in combinations(sorted(set(prints)), 2) if (a ^ b).bit_count() <= 4]
    root = classes_of(set(prints), links)
    least = {}
    for (doc, _), fp in zip(rows, prints):
        if doc is not None:
            least[root[fp]] = min(least.get(root[fp], doc), doc)
    want = sorted(((d, fp, least.get(root[fp])) for (d, _), fp in zip(rows, prints)), key=str)
    got = simhash.simhash_classes(frame(spark, rows), 4, 4).collect()
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component"]) for r in got), key=str) == want


@pytest.mark.parametrize("tile", [4, 1024])
def test_dense_ball_of_fingerprints(spark, tile):
    """Long lists are cut into tiles; no link is lost."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(300)}
    fps |= {rng.getrandbits(64) for _ in range(300)}
    signed = np.array(sorted(fps), np.uint64).view(np.int64)
    links = [(int(a), int(b)) for a, b in combinations(signed, 2) if (int(a) ^ int(b)) % (1 << 64) and
             ((int(a) % (1 << 64)) ^ (int(b) % (1 << 64))).bit_count() <= 4]
    want = classes_of([int(x) for x in signed], links)
    found = simhash.fingerprint_links(spark.createDataFrame([(int(x),) for x in signed], "fp long"), 4, tile)
    got = {r["node"]: r["component"] for r in components(found).collect()}
    assert got == {n: c for n, c in want.items() if any(n in pair for pair in links)}


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(200, 100 + i) for i in range(50)] + [(7, 7), (300, 301), (301, 300)]
    got = {r["node"]: r["component"] for r in components(
        spark.createDataFrame([*links, (None, 5)], "a long, b long")).collect()}
    want = classes_of({n for pair in links for n in pair}, links)
    assert got == {n: c for n, c in want.items()}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_class_stays(spark, docs):
    kept = simhash.keep_first(docs, 4, 4)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(7) == 0 and ids.count(6) == 1 and len(ids) == len(set(ids))
    assert [r["text"] for r in kept.where("doc_id IS NULL").collect()] == ["no id here"]
    assert simhash.keep_first(empty(spark), 4, 4).collect() == []
