"""Repeated passages against a count of every window of 400 bytes."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from fixtures import empty, frame, stored, texts
from orderweave.llm import repeats


def brute(rows, length, keep):
    """{(id, text): (bytes, removed, runs, hash of the rest)} by counting all windows."""
    where = defaultdict(list)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    data = [(t or "").encode() for _, t in rows]
    for i in order:
        for p in range(len(data[i]) - length + 1):
            where[data[i][p:p + length]].append((i, p))
    gone = [np.zeros(len(d), bool) for d in data]
    for places in where.values():
        if len(places) > 1:
            for i, p in places[keep == "first":]:
                gone[i][p:p + length] = True
    out = []
    for (doc, _), d, mask in zip(rows, data, gone):
        kept = np.frombuffer(d, np.uint8)[~mask].tobytes()
        runs = int((mask & ~np.r_[False, mask[:-1]]).sum()) if len(mask) else 0
        out.append((doc, len(d), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def digest(spark, rows, length, keep):
    df = repeats.repeat_digest(frame(spark, rows), length, keep)
    return Counter(tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


def test_first_and_last_copies_go(spark):
    rows = texts()
    assert digest(spark, rows, 400, "none") == brute(rows, 400, "none")


def test_first_copy_stays(spark):
    rows = [r for r in texts() if r != (7, None)]
    seen, once = set(), []
    for r in rows:  # rows that repeat id and text share one fate, which is stated
        if r not in seen:
            seen.add(r)
            once.append(r)
    # equal ids with different texts have no stated order
    once = [r for r in once if r[0] is not None]
    assert digest(spark, once, 400, "first") == brute(once, 400, "first")


@pytest.mark.parametrize("length", [16, 64])
def test_short_windows_and_stored_documents(spark, length):
    rows = stored("documents", "doc_id, text")[:120]
    assert digest(spark, rows, length, "none") == brute(rows, length, "none")
    assert digest(spark, rows, length, "first") == brute(rows, length, "first")


def test_groups_and_batches_of_any_size(spark, monkeypatch):
    """Hot anchors dealt out by window, and windows merged in tiny batches, change nothing."""
    from fixtures import passage

    shared = passage(50, 90)
    rows = [(i, passage(100 + i, 8) + " " + shared + " " + passage(300 + i, 8)) for i in range(40)]
    want = brute(rows, 400, "none"), brute(rows, 400, "first")
    monkeypatch.setattr(repeats, "GROUP", 3)
    monkeypatch.setattr(repeats, "MERGED", 50)
    assert (digest(spark, rows, 400, "none"), digest(spark, rows, 400, "first")) == want


def test_long_text_in_stretches(monkeypatch):
    data = np.random.default_rng(1).integers(97, 101, 9000).astype(np.uint8)
    whole = repeats.anchors(data, 64)
    monkeypatch.setattr(repeats, "STRETCH", 700)
    cut = repeats.anchors(data, 64)

    def by_window(found):
        return {p: int(k) for k, _, a, b in zip(*found) for p in range(a, b + 1)}

    assert by_window(whole) == by_window(cut)
    assert len(by_window(cut)) == len(data) - 64 + 1


def test_empty_table_and_texts(spark):
    assert repeats.repeat_digest(empty(spark)).collect() == []
    got = {r["doc_id"]: r["text"] for r in repeats.remove_repeats(frame(spark, [(1, None), (2, ""), (3, "é")])).collect()}
    assert got == {1: None, 2: "", 3: "é"}
