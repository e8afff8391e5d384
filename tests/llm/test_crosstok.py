from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow.compute as pc
import pytest
import sentencepiece
from fixtures import TABLES, empty, frame, passage, stored, texts
from tokenizers import Tokenizer

from orderweave.llm import crosstok
from orderweave.llm.queries import BYTE_TOKENIZER, PIECE_MODEL, QUERIES

ODD = ["a  b\n c\td 'S it's <|endoftext|>x y <s> </s> <unk> <0x41> z 12345 ¡¡ DON'T", "▁ has the mark", "ﬁ ½    nbsp x",
       "日本語 text 🙂🙂🙂 é́", " ", "  lead", "trail  ", "a" * 3000, "\x00\x01", "\n\n", "ab " * 500, "ﷺ", "The the THE the."]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(BYTE_TOKENIZER)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def groups_of(text, a, b):
    """Plainly: end offsets as sets, token by token."""
    if not text:
        return None
    alphabet = crosstok.byte_of_char()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    want = (" " + text).encode()
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return None

    def ends(tokens):
        out, at = [], 0
        for t in tokens:
            at += len(t)
            out.append(at)
        return out

    ends_a, ends_b = ends(bytes_a), ends(bytes_b)
    out = []
    low = 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        out.append(([i for i, e in zip(ids_a, ends_a) if low < e <= cut], [i for i, e in zip(ids_b, ends_b) if low < e <= cut]))
        low = cut
    return out


def brute(rows, a, b):
    found = [(i, groups_of(t, a, b)) for i, t in rows]
    count = Counter()
    for _, groups in found:
        count.update({(x, y) for p, q in groups or [] for x in p for y in q})
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for i, groups in found:
        if groups is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for p, q in groups for x in p for y in q]
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((i, sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), len(links),
                    sum(count[link] == top[link[0]] for link in links), sum(count[link] for link in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str), count


def short_rows():
    rows = [(i, t) for i, t in texts() if t is None or len(t) < 5000]
    return rows + [(100 + i, t) for i, t in enumerate(ODD)] + [(i + 1000, t) for i, t in stored("documents", "doc_id, text")[:40]
                                                             if len(t) < 6000]


@pytest.mark.parametrize("sizes", [crosstok.Sizes(), crosstok.Sizes(3000, 40, 500)])
def test_same_as_token_by_token(spark, both, sizes):
    rows = short_rows()
    want, count = brute(rows, *both)
    docs = frame(spark, rows).repartition(3)
    got = sorted(map(tuple, crosstok.align_documents(docs, BYTE_TOKENIZER, PIECE_MODEL, sizes).collect()), key=str)
    assert got == want
    pairs = crosstok.id_pairs(docs, BYTE_TOKENIZER, PIECE_MODEL, sizes).collect()
    assert {(r.a, r.b): r.n for r in pairs} == count


def test_documents_added_up_one_at_a_time(spark, both, monkeypatch):
    """Blocks of documents end anywhere; a document that is larger than a block, or has no windows, is one too."""
    rows = short_rows()
    docs = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    stored = crosstok._stored_chunks(docs, BYTE_TOKENIZER, PIECE_MODEL, crosstok.Sizes()).toArrow()
    known = stored.filter(pc.not_equal(stored["kind"], "doc"))
    known = known.append_column("best", pc.equal(known["n"], 1))
    documents = stored.filter(pc.equal(stored["kind"], "doc"))
    want = crosstok._add_up(None, documents, known).to_pylist()
    monkeypatch.setattr(crosstok, "ADDED_AT_ONCE", 7)
    assert crosstok._add_up(None, documents, known).to_pylist() == want and len(want) == len(rows)


def test_groups_as_rows(spark, both):
    rows = short_rows()[-12:]
    got = crosstok.token_groups(frame(spark, rows), BYTE_TOKENIZER, PIECE_MODEL).collect()
    assert {r.doc_id: [(g.a, g.b) for g in r.groups] for r in got} == {i: groups_of(t, *both) or [] for i, t in rows}


def test_parts_encode_as_the_whole_text(both):
    rng = random.Random(3)
    text = " ".join(passage(n, 40) + rng.choice(["", "  ", "\n", "\t x", "  y", " 日本 "]) for n in range(60))
    parts = crosstok.parts_of(text)
    assert len(parts) > 10 and " ".join(parts) == text
    a, b = both
    assert sum((a.encode(" " + p, add_special_tokens=False).ids for p in parts), []) == a.encode(" " + text, add_special_tokens=False).ids
    assert sum((b.encode(p) for p in parts), []) == b.encode(text)
    assert crosstok.parts_of("a  b\n c d ") == ["a  b\n c", "d "] and crosstok.parts_of("") == [""]


def test_one_long_group(both):
    """p * q links of a group are counted, not listed."""
    vocabulary = crosstok.Vocabulary([b"x"] * 10)
    one = SimpleNamespace(
        va=vocabulary, vb=vocabulary, a=np.full(5000, 1), b=np.r_[np.full(4000, 2), 3], ga=np.array([5000]),
        gb=np.array([4001]), from_a=np.zeros(1, int), from_b=np.zeros(1, int), cut=np.zeros(1, int))
    place, pairs, times = crosstok.Aligned.links(one, np.zeros(1, int))
    assert times.sum() == 5000 * 4001 and sorted(times) == [5000, 20_000_000]
    assert place.tolist() == [0, 0] and pairs.tolist() == [12, 13]


def test_empty_table_and_text_ids(spark):
    assert crosstok.align_documents(empty(spark), BYTE_TOKENIZER, PIECE_MODEL).collect() == []
    named = spark.createDataFrame([("x", "a b"), ("y", None)], "doc_id string, text string")
    got = {r.doc_id: r.n_a for r in crosstok.align_documents(named, BYTE_TOKENIZER, PIECE_MODEL).collect()}
    assert got == {"x": 2, "y": 0}


def test_query(spark):
    df = QUERIES["op11_cross_tokenizer"](spark, TABLES)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert df.count() == len(stored("documents", "doc_id"))
