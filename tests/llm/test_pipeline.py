"""The stages one after the other, against plain versions of each on its own input."""

from __future__ import annotations

import re
from collections import Counter

import pytest

import corpus_pipeline
from fixtures import TABLES, empty, frame, passage
from orderweave.llm import pieces, pii, toxicity
from orderweave.session import materialize
from test_native import shingles
from test_pii import PLAIN, good
from test_simhash import classes_of, plain_fingerprint
from test_tokens import best_cut


def rows_of(df):
    return {(r["doc_id"], r["text"]) for r in df.collect()}


@pytest.fixture(scope="module")
def staged(spark):
    out = [materialize(spark.read.parquet(f"{TABLES}/documents.parquet"), "raw")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], TABLES), name))
    return out


def test_columns_stay(staged):
    for df in staged[1:-1]:
        assert df.dtypes == staged[0].dtypes


def test_toxic_documents_go(spark, staged):
    scores = toxicity.score_documents(staged[0], spark.read.parquet(f"{TABLES}/labels.parquet"))
    toxic = {r["doc_id"] for r in scores.where("predicted = 1").collect()}
    assert rows_of(staged[1]) == {r for r in rows_of(staged[0]) if r[0] not in toxic}


def test_one_of_near_copies(staged):
    rows = sorted(rows_of(staged[1]))
    prints = {d: plain_fingerprint(t) for d, t in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    root = classes_of(list(prints), links)
    assert rows_of(staged[2]) == {r for r in rows if root[r[0]] == r[0]}


def test_no_benchmark_items(spark, staged):
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()]
    want = {r for r in rows_of(staged[2]) if not any(
        len(s & shingles(r[1])) >= 0.8 * len(s) for s in items if s)}
    assert rows_of(staged[3]) == want


def test_personal_data_is_gone(staged):
    before, after = dict(rows_of(staged[3])), dict(rows_of(staged[4]))
    assert before.keys() == after.keys()
    for doc, text in after.items():
        assert not [k for k, p in PLAIN.items() if k != "card" for m in re.finditer(p, text) if good(k, m[0])]
        clean = not any(good(k, m[0]) for k, p in PLAIN.items() for m in re.finditer(p, before[doc]))
        if clean and not re.search("|".join(pii.PATTERNS[k].replace("\\p{L}", "[^\\W\\d_]").replace(
                "\\p{Lu}", "[^\\W\\d_]").replace("\\x20", " ") for k in pii.ADDED), before[doc]):
            assert text == before[doc]


def test_pieces(staged):
    model = pieces.PieceModel(corpus_pipeline.PIECE_MODEL)
    after = dict(rows_of(staged[4]))
    got = staged[5].collect()
    assert Counter(r["doc_id"] for r in got) == Counter(list(after))
    for r in sorted(got, key=lambda r: r["doc_id"])[:12]:
        assert r["ids"] == best_cut(model, model.normalise(after[r["doc_id"]])) and r["round_trip"]


def test_run_is_the_stages(spark, staged):
    columns = ["doc_id", "n_pieces", "round_trip"]
    assert sorted(corpus_pipeline.run(spark, TABLES).select(*columns).collect()) == sorted(
        staged[5].select(*columns).collect())


def test_odd_and_empty_documents(spark):
    for rows in (frame(spark, [(1, None), (2, ""), (None, "x"), (3, passage(1, 50)), (3, passage(1, 50))]), empty(spark)):
        docs = rows.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, TABLES), name)
        assert docs.count() == (0 if rows.isEmpty() else 3)
