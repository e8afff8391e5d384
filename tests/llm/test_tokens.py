"""Token blocks and piece encoding: exact round trips and whole-text encoding."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fixtures import empty, frame, stored, texts
from orderweave.llm import pieces, tokenstore
from orderweave.llm.queries import END_ID, PIECE_MODEL, WORD_TOKENIZER

ODD = ["a  b\n c\td 'S it's <|endoftext|>x y<|startoftext|> ́z Σας ΣΑΣ İx \x1c y z é 12345 ¡¡ DON'T x<y",
       "", " ", "  x ", "a\x7fb \x00 x", "▁ a▁b ▁▁", "\U0001F600 ok"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD_TOKENIZER)


def test_words_encode_as_the_whole_text(tokenizer):
    encode = tokenstore.word_encoder(WORD_TOKENIZER)
    for text in ODD + [t or "" for _, t in texts()] + [t for _, t in stored("documents", "doc_id, text")]:
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=700), min_size=1, max_size=8))
def test_block_round_trip(lists):
    ids = np.array([i for x in lists for i in x], np.uint32)
    block = tokenstore.Block(tokenstore.encode_block([None, *range(1, len(lists))], [len(x) for x in lists], ids))
    assert [block.document(n).tolist() for n in range(len(lists))] == lists
    assert block.doc_ids == [None, *range(1, len(lists))]
    for at in {0, len(ids) - 1, len(ids) // 2, len(ids) // 3}:
        assert block.token(at) == ids[at]


def test_store_and_read(spark, tokenizer):
    rows = texts() + stored("documents", "doc_id + 1000, text")
    got = tokenstore.store_and_read(frame(spark, rows), WORD_TOKENIZER, END_ID).collect()
    assert len(got) == len(rows)
    at = 0
    by_id = {}
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")
        by_id.setdefault(doc, []).append((len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        by_id[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"], bytes(r["ids"])))
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert tokenstore.store_and_read(empty(spark), WORD_TOKENIZER, END_ID).collect() == []


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PIECE_MODEL)


def best_cut(model, normal):
    """All boundaries at once: the best score to each, and of equal ones the longest last piece."""
    best, back = [0.0], [0]
    for end in range(1, len(normal) + 1):
        options = []
        for start in range(max(0, end - model.longest), end):
            known = model.score.get(normal[start:end])
            if known:
                options.append((best[start] + known[0], -start))
            elif start == end - 1:
                options.append((best[start] + model.unknown, -start))
        score, start = max(options)
        best.append(score)
        back.append(-start)
    out, end = [], len(normal)
    while end:
        start = back[end]
        known = model.score.get(normal[start:end])
        out = ([known[1]] if known else model.unknown_ids(normal[start:end])) + out
        end = start
    return out


def test_streamed_search_is_the_best_cut(model):
    encode = pieces.piece_encoder(model)
    long_word = "x" * 500 + "abcdefgh" * 200 + "漢字" * 50
    for text in ODD + [long_word, long_word + " " + long_word] + [t or "" for _, t in texts()[:16]] + [
            t for _, t in stored("documents", "doc_id, text")[:25]]:
        normal = model.normalise(text)
        want = best_cut(model, normal)
        assert [i for part in pieces.stream_viterbi(model, normal) for i in part] == want
        assert list(encode(text)) == want
        assert model.decode(want) == text.replace(pieces.MARK, " ")


def test_ids_come_before_the_text_ends(model):
    fed = 0

    def characters():
        nonlocal fed
        for c in model.normalise("the cat sat on the mat " * 200):
            fed += 1
            yield c

    parts = pieces.stream_viterbi(model, characters())
    next(parts)
    assert fed < 200


def test_documents(spark, docs, model):
    got = pieces.encode_documents(docs, PIECE_MODEL)
    rows = got.collect()
    assert len(rows) == docs.count() and all(r["round_trip"] for r in rows)
    assert [r["ids"] for r in rows if r["doc_id"] in (1, 2)] == [[], []]
    back = pieces.decode_documents(got.select("doc_id", "ids"), PIECE_MODEL)
    want = sorted((str(d), (t or "")) for d, t in texts())
    assert sorted((str(r["doc_id"]), r["text"]) for r in back.collect()) == want
    assert pieces.encode_documents(empty(spark), PIECE_MODEL).collect() == []
