from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, duck_rows, spark_rows
from fixtures import empty, frame, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from orderweave.llm import phrases
from orderweave.llm.queries import ORACLE, QUERIES

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, longest, top, percent):
    """(lang, text) rows, with plain dictionaries."""
    out = []
    for lang in {x or "und" for x, _ in rows}:
        count = Counter()
        for x, text in rows:
            if (x or "und") != lang:
                continue
            for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
                w = re.findall("[^ \t]+", piece)
                count.update(tuple(w[i:i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
        n = sum(c for p, c in count.items() if len(p) == 1)
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * f >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, f in found.items()):
                continue
            score, _, l, r = min((1000 * a * n // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]])
                                 for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def some_rows():
    rng = random.Random(9)
    words = ["the", "The", "of", "a", "Maß", "ÄB", "x\x85y", "\x1cz", "日本", "new", "york", "city"]
    rows = []
    for i in range(300):
        t = " ".join(rng.choice(words[:rng.randint(2, 12)]) for _ in range(rng.randint(0, 30)))
        rows.append((rng.choice(["en", "en", "en", None, "und", "de"]), t.replace(" a", rng.choice([". a", "\ta", "  a", "\ra", " a"]))))
    rows += [("en", "in new york city the big apple never sleeps")] * 90 + [("en", "of the of the of the")] * 40
    return rows + [("en", None), ("en", ""), ("fr", "..."), ("fr", None), (None, " one ")] + [("de", t) for _, t in texts()]


@pytest.mark.parametrize("sizes,longest,percent", [
    (phrases.Sizes(), 5, 100), (phrases.Sizes(500, 40), 5, 100), (phrases.Sizes(2000, 100), 3, 60), (phrases.Sizes(500, 40), 2, 100)])
def test_same_as_plain_counting(spark, sizes, longest, percent):
    rows = some_rows()
    docs = spark.createDataFrame(
        [(i, lang, text, 0, "p", 1) for i, (lang, text) in enumerate(rows)],
        "doc_id long, lang string, text string, n long, phrase string, prefix int").repartition(3)
    got = phrases.mine_phrases(docs, 20, longest, 40, percent, sizes).collect()
    assert sorted(map(tuple, got)) == brute(rows, 20, longest, 40, percent)


def test_no_rows(spark):
    assert phrases.mine_phrases(empty(spark)).collect() == []
    assert phrases.mine_phrases(frame(spark, [(1, None), (2, "a b")])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-1, 3), min_size=1, max_size=60), st.integers(2, 5))
def test_nodes_of_a_subtree(words, longest):
    matrix, counts = phrases.merged(phrases.suffixes(np.array(words), longest), np.ones(
        len(phrases.suffixes(np.array(words), longest)), np.int64))
    for depth in range(2, longest + 1):
        want = Counter(tuple(words[i:i + depth]) for i in range(len(words) - depth + 1) if -1 not in words[i:i + depth])
        tops, totals = phrases.nodes(matrix, counts, depth)
        assert dict(zip(map(tuple, tops.tolist()), totals.tolist())) == want


def test_counts_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**16, 9 * 10**16, 10**16, 10**16)], "a long, total long, l long, r long")
    assert row.selectExpr(phrases._exact_score()).first()[0] == 1000 * 10**16 * 9 * 10**16 // 10**32


def test_query_is_the_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert spark_rows(QUERIES["op12_collocations"](spark, folder)) == duck_rows(connect(folder), ORACLE["op12_collocations"])


def test_chunks_and_buckets_are_packed_rows(spark, monkeypatch):
    """No table that is written has a row for each chunk and word, and only pairs of lengthened words are counted for lengthening."""
    written, real = {}, phrases.materialize
    monkeypatch.setattr(phrases, "materialize", lambda df, label: written.setdefault(label, []).append(real(df, label)) or written[label][-1])
    rows = some_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = phrases.mine_phrases(docs, 20, 5, 40, 100, phrases.Sizes(500, 40, 30)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 20, 5, 40, 100)
    chunks = written["word-chunks"][0]
    assert chunks.count() == chunks.select("chunk").distinct().count() >= written["placed-chunks"][0].count() > 10
    counted = written["word-counts"][0].where("chunk IS NOT NULL")
    assert counted.count() == counted.select("bucket", "chunk").distinct().count()
    assert counted.select("bucket").distinct().count() > 1
    heavy = {r["gid"] for r in written["numbered-words"][0].where("budgets IS NOT NULL").collect()}
    assert heavy and all(set(r["prefix"]) <= heavy for df in written["prefixes"] for r in df.collect())


@given(st.lists(st.integers(-2**31, 2**31 - 1)))
def test_packed_numbers_come_back(numbers):
    for kind in ("<i4", "<i8"):
        assert phrases.unpack(phrases.pack(np.array(numbers, np.int64), kind), kind).tolist() == numbers
