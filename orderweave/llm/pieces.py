"""SentencePiece encoding by a streaming Viterbi search, and decoding.

Text is normalised as the model file says (identity, a space before the text, spaces as the piece mark). Of all ways to cut
the text into pieces, the one with the largest sum of piece scores wins; of equal ones, at each boundary, the one with the
longest last piece. The search keeps scores for a window of the longest piece's length. Whenever the backpointer paths of
all ends in the window run through one boundary, the ids up to it are final and are given out, so memory does not grow
with the text. A character that no piece covers costs ten more than the worst piece and is written as byte pieces.

No piece of the model crosses from another character to a piece mark (checked when it is loaded), so all paths meet there. A word
with its mark is therefore searched once per worker while it stays in a bounded cache.

Defined cases: a null or empty text has no ids; doc_ids may be null or repeat, every row gives one row; other columns are left
out; an empty table gives no rows. Decoding gives the text back, except that a piece mark in the text reads as a space.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words a worker remembers; longer ones are searched as a stream each time.
CACHED_WORDS, CACHED_LENGTH = 1 << 20, 48

NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6  # fixed values: the kinds of pieces in a model file


class PieceModel:
    """Pieces, scores and byte pieces of a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kind = model.normalizer_spec
        if kind.precompiled_charsmap or kind.remove_extra_whitespaces or not kind.escape_whitespaces:
            raise ValueError("only models with identity normalisation are read")
        self.dummy_prefix = kind.add_dummy_prefix
        self.text = [p.piece for p in model.pieces]
        self.kind = [p.type for p in model.pieces]
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte pieces")
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.score = {p.piece: (p.score, i) for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER_DEFINED)}
        #: Pieces, and with an empty entry the strings that only begin one.
        self.known: dict[str, tuple] = {p[:n]: () for p in self.score for n in range(1, len(p))}
        self.known.update(self.score)
        #: The pieces by character; the empty key of a node holds the score of the piece that ends there.
        self.trie: dict = {}
        for piece, (score, _) in self.score.items():
            node = self.trie
            for character in piece:
                node = node.setdefault(character, {})
            node[""] = score
        self.unknown = min(s for s, _ in self.score.values()) - UNKNOWN_PENALTY
        self.bytes_of = [
            b"" if kind in (CONTROL, UNKNOWN) else bytes([self.byte_of[i]]) if kind == BYTE else piece.encode()
            for i, (piece, kind) in enumerate(zip(self.text, self.kind))]
        self.longest = max(map(len, self.score))
        self.marks_lead = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.score)

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        return (MARK if self.dummy_prefix else "") + text.replace(" ", MARK)

    def unknown_ids(self, character: str) -> list[int]:
        return [self.byte_id[b] for b in character.encode("utf-8", "replace")]

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def stream_viterbi(model: PieceModel, characters: Iterable[str]) -> Iterator[list[int]]:
    """Ids of already normalised characters, given out as soon as no later character can change them."""
    longest, known = model.longest, model.known
    window = ""                        # characters since the last boundary given out
    best: list[float | None] = [0.0]   # by boundary of the window; None: not reached yet
    back = [0]                         # length of the last piece
    at = 0                             # pieces that start before ``at`` have been tried

    def try_from(start: int) -> None:
        """Tries all pieces that start here. At equal scores the earlier start, so the longer piece, stays."""
        score, end, single = best[start], start + 1, False
        while end <= len(window):
            entry = known.get(window[start:end])
            if entry is None:
                break
            if entry:
                single = single or end == start + 1
                total = score + entry[0]
                if best[end] is None or total > best[end]:
                    best[end], back[end] = total, end - start
            end += 1
        if not single:
            total = score + model.unknown
            if best[start + 1] is None or total > best[start + 1]:
                best[start + 1], back[start + 1] = total, 1

    def ids_to(end: int) -> list[int]:
        cuts = [end]
        while cuts[-1]:
            cuts.append(cuts[-1] - back[cuts[-1]])
        out: list[int] = []
        for a, b in zip(cuts[:0:-1], cuts[-2::-1]):
            entry = known.get(window[a:b])
            out += [entry[1]] if entry else model.unknown_ids(window[a:b])
        return out

    def meeting() -> int:
        """The last boundary that the paths to all ends reached so far, from ``at`` on, have in common."""
        ends = {end for end in range(at, len(best)) if best[end] is not None}
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            ends.add(last - back[last])
        return ends.pop()

    check = 2 * longest
    for character in characters:
        window += character
        best.append(None)
        back.append(0)
        if len(window) - at < longest:
            continue
        try_from(at)
        at += 1
        if at >= check:
            met = meeting()
            if met:
                yield ids_to(met)
                base = best[met]
                window, back, at = window[met:], back[met:], at - met
                best = [None if score is None else score - base for score in best[met:]]
                check = 2 * longest
            else:
                check = at + longest
    while at < len(window):
        try_from(at)
        at += 1
    if window:
        yield ids_to(len(window))


def _whole(model: PieceModel, segment: str) -> list[int]:
    """The same search for a segment that is at hand as a whole, such as a word."""
    known, n = model.known, len(segment)
    best, back, characters = [0.0] + [-inf] * n, [0] * (n + 1), list(segment)
    for start in range(n):
        score, end, node, single = best[start], start, model.trie, False
        for character in characters[start:]:
            node = node.get(character)
            if node is None:
                break
            end += 1
            if "" in node:
                if end == start + 1:
                    single = True
                total = score + node[""]
                if total > best[end]:
                    best[end], back[end] = total, start
        if not single and score + model.unknown > best[start + 1]:
            best[start + 1], back[start + 1] = score + model.unknown, start
    out, end = [], n
    while end:
        start = back[end]
        entry = known.get(segment[start:end])
        out += [entry[1]] if entry else model.unknown_ids(segment[start:end])[::-1]
        end = start
    return out[::-1]


@lru_cache(maxsize=2)
def model_and_encoder(path: str) -> tuple[PieceModel, Callable[[str], array]]:
    """One model and one encoder, with its cache, for all tasks of a worker process."""
    model = PieceModel(path)
    return model, piece_encoder(model)


def piece_encoder(model: PieceModel) -> Callable[[str], array]:
    """Text to an array of ids."""
    known: dict[str, bytes] = {}
    runs = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def search(segment: str) -> bytes:
        if len(segment) <= CACHED_LENGTH:
            return array("i", _whole(model, segment)).tobytes()
        out = array("i")
        for ids in stream_viterbi(model, segment):
            out.extend(ids)
        return out.tobytes()

    def encode(text: str) -> array:
        normal, out = model.normalise(text), array("i")
        if not normal:
            return out
        if not model.marks_lead:
            out.frombytes(search(normal))
            return out
        if normal[0] == MARK and MARK + MARK not in normal and normal[-1] != MARK:
            words = normal[1:].split(MARK)  # each has one mark before it
            fresh = set(words).difference(known)
            if len(known) + len(fresh) > CACHED_WORDS:
                known.clear()
                fresh = set(words)
            for word in fresh:
                known[word] = search(MARK + word)
            out.frombytes(b"".join(map(known.__getitem__, words)))
            for word in fresh:
                if len(word) > CACHED_LENGTH:
                    del known[word]
            return out
        for segment in runs.findall(normal):
            plain = segment[:1] == MARK and segment[1:2] not in ("", MARK)
            out.frombytes(known.get(segment[1:]) or search(segment) if plain else search(segment))
        return out

    return encode


def encode_documents(docs: DataFrame, model_path: str, id_column: str = "doc_id",
                     text_column: str = "text") -> DataFrame:
    """id, ids (array<int>), n_pieces and round_trip: whether decoding gives the normalised text back."""
    kind = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, encode = model_and_encoder(model_path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                texts = [x or "" for x in part.column(1).to_pylist()]
                ids = [encode(x) for x in texts]
                offsets = [0]
                for x in ids:
                    offsets.append(offsets[-1] + len(x))
                flat = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(x.tobytes() for x in ids))])
                same = [model.decode(x) == t.replace(MARK, " ") for x, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                    pa.array([len(x) for x in ids], pa.int64()), pa.array(same, pa.bool_())],
                    names=[id_column, "ids", "n_pieces", "round_trip"])

    return docs.select(id_column, text_column).mapInArrow(
        run, f"`{id_column}` {kind}, ids array<int>, n_pieces long, round_trip boolean")


def decode_documents(encoded: DataFrame, model_path: str, ids_column: str = "ids", out: str = "text") -> DataFrame:
    """All columns but the ids, and the decoded text; null ids give a null text."""
    kept = [c for c in encoded.columns if c not in (ids_column, out)]
    fields = ", ".join([f"`{c}` {kind}" for c, kind in encoded.dtypes if c in kept] + [f"`{out}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = model_and_encoder(model_path)
        for batch in batches:
            texts = [None if ids is None else model.decode(ids) for ids in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(kept))] + [pa.array(texts, pa.string())], names=[*kept, out])

    return encoded.select(*kept, ids_column).mapInArrow(run, fields)
