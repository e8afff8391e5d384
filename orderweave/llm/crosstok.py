"""Alignment of two tokenizers over a corpus: which ids of one stand for which ids of the other.

Space and text is encoded whole by a byte-level tokenizer file (A), the text by a piece model (B), which puts the space itself.
Byte offsets where tokens of both end cut a text into groups, and all A and B tokens of a group are linked.

1. After both encodings, the shared ends before which A's and B's next tokens are both space-marked are anchors. They are
   verified by their byte offsets and split a text into windows of token ids, mostly words. At a single space between other
   characters both tokenizers begin anew (the vocabulary of B is looked at for that, tests compare whole texts), so a text is its
   parts between such spaces, and a part is encoded and aligned once in a chunk.
2. Equal windows align equally, so an alignment is worked out once for each pair of id tuples and kept while a chunk of texts
   lasts. A text is then a list of window numbers.
3. A chunk knows in how many of its documents each id pair is linked. Those counts are summed by Spark, compared
   with the highest of their A id, and joined back to the chunks that hold the pair; a chunk turns them into sums for each of
   its windows, and its documents add up their windows. So what is shuffled are the different pairs of a chunk and window numbers.

A chunk is a bounded number of characters and of different windows, whatever the partitions; the counts of a hot pair are
combined per chunk, and the join is split where one pair is in very many chunks. A group of p A tokens and q B tokens holds
p * q links; they are counted by the different ids of the group, so a long group costs no more than its tokens.

Defined cases: a null or empty text, or one whose joined token bytes of A or B are not space and text (as where B rewrites characters
or the text holds U+2581), has no tokens: zeros and an empty digest. Special tokens' strings are plain text. Every row is a
document of its own, repeated ids and texts too; a null id stays null; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import ctypes
import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderweave.session import materialize

#: A single space between other characters.
CUT = re.compile(r"(?<=\S) (?=\S)")
SPACE = "▁"
#: A group of up to so many links is written out link by link.
WRITTEN_OUT = 64
#: Rows of a batch that are Python strings at one time.
AT_ONCE = 500
#: Windows of documents that are added up at one time.
ADDED_AT_ONCE = 1 << 19
#: Between the ids of A and of B in the key of a window; no id is -1.
BETWEEN = b"\xff" * 4


class Sizes(NamedTuple):
    """A chunk is closed beyond so many characters of text, or different windows; characters encoded together."""

    chunk: int = 1 << 25
    windows: int = 1 << 18
    together: int = 1 << 17


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, all other bytes, in order, for U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Vocabulary:
    """Bytes of every id of one tokenizer, their lengths, and which begin with a space."""

    def __init__(self, entries: list[bytes]):
        self.bytes = entries
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.marked = np.array([e[:1] == b" " for e in entries], bool)


@lru_cache(maxsize=2)
def tokenizers(byte_file: str, piece_file: str):
    """(encode A, vocabulary A, encode B, vocabulary B, whether texts may be cut), once for all tasks of a worker process."""
    import sentencepiece
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
    a = Tokenizer.from_file(byte_file)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
    alphabet = byte_of_char()
    entries = [b""] * a.get_vocab_size()
    for entry, i in a.get_vocab().items():
        entries[i] = bytes(alphabet[c] for c in entry) if set(entry) <= set(alphabet) else entry.encode()
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    # a text may be cut before a space where no piece goes on behind one
    cut = not any(SPACE in p.lstrip(SPACE) for p in pieces)
    rendered = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]

    def run_a(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)])

    def run_b(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(b.encode(texts, num_threads=1))

    return run_a, Vocabulary(entries), run_b, Vocabulary(rendered), cut


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one row, and how many each text has."""
    many = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter(chain.from_iterable(rows), np.int32, int(many.sum())), many


@lru_cache(maxsize=1)
def written_ids(size: int) -> tuple[list[str], np.ndarray]:
    """Every id in decimal behind each of the three separators of a digest, and their lengths."""
    table = [mark + str(i) for mark in ";,|" for i in range(size)]
    return table, np.fromiter(map(len, table), np.int64, len(table))


def give_back() -> None:
    """What the encoding step left in a worker that Spark uses again: tokenizers, their tables and freed memory."""
    tokenizers.cache_clear()
    written_ids.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library; others have none
    if trim:
        trim(0)


def parts_of(text: str, cut: bool = True) -> list[str]:
    """The text cut at single spaces between other characters; these spaces are left out."""
    return CUT.split(text) if cut else [text]


class Aligned:
    """Some texts by both tokenizers, with the groups and windows of all of them in one row of tokens."""

    def __init__(self, texts: list[str], byte_file: str, piece_file: str):
        encode_a, self.va, encode_b, self.vb, _ = tokenizers(byte_file, piece_file)
        (a, n_a), (b, n_b) = encode_a(texts), encode_b(texts)
        whole = [(" " + t).encode("utf-8", "surrogatepass") for t in texts]
        given = np.fromiter(map(bool, texts), bool, len(texts))
        self.sound = given & _spells(self.va, a, n_a, whole) & _spells(self.vb, b, n_b, whole)
        self.n_a, self.n_b = (np.where(self.sound, n, 0) for n in (n_a, n_b))
        self.a, self.b = a[np.repeat(self.sound, n_a)], b[np.repeat(self.sound, n_b)]
        ends_a, ends_b = np.cumsum(self.va.lengths[self.a]), np.cumsum(self.vb.lengths[self.b])
        _, self.ga, self.gb = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        self.ga, self.gb = self.ga + 1, self.gb + 1  # behind the last tokens of each group
        self.from_a, self.from_b = (np.r_[0, g][:-1] for g in (self.ga, self.gb))
        # a window ends with its text, or where the next tokens of both are space-marked
        ahead_a, ahead_b = (np.r_[v.marked[ids], True] for v, ids in ((self.va, self.a), (self.vb, self.b)))
        last = np.isin(self.ga, np.cumsum(self.n_a))
        self.cut = np.flatnonzero(last | ahead_a[self.ga] & ahead_b[self.gb])
        #: For each window, the text it is of.
        self.doc = np.searchsorted(np.cumsum(self.n_a), self.ga[self.cut], side="left")

    def windows(self) -> Iterator[tuple[bytes, int, int, int, int]]:
        """(id tuples, first group, behind the last group, first token of A and of B) of each window, in order."""
        raw_a, raw_b = self.a.tobytes(), self.b.tobytes()
        ends_a, ends_b = (4 * self.ga[self.cut]).tolist(), (4 * self.gb[self.cut]).tolist()
        at_a = at_b = group = 0
        for end_a, end_b, cut in zip(ends_a, ends_b, self.cut.tolist()):
            yield raw_a[at_a:end_a] + BETWEEN + raw_b[at_b:end_b], group, cut + 1, at_a >> 2, at_b >> 2
            at_a, at_b, group = end_a, end_b, cut + 1

    def groups(self, first: int, behind: int, at_a: int, at_b: int) -> list[tuple[list[int], list[int]]]:
        out = []
        for end_a, end_b in zip(self.ga[first:behind].tolist(), self.gb[first:behind].tolist()):
            out.append((self.a[at_a:end_a].tolist(), self.b[at_b:end_b].tolist()))
            at_a, at_b = end_a, end_b
        return out


    def digest_texts(self) -> list[str]:
        """The groups of each text, written out: A's ids of a group, then B's, in one row for all texts."""
        size = max(len(self.va.bytes), len(self.vb.bytes))
        table, lengths = written_ids(size)
        code = np.empty(len(self.a) + len(self.b), np.int64)
        # so many tokens of the other side come before
        ahead_a, ahead_b = np.repeat(self.from_b, self.ga - self.from_a), np.repeat(self.ga, self.gb - self.from_b)
        code[np.arange(len(self.a)) + ahead_a] = self.a + size
        code[np.arange(len(self.b)) + ahead_b] = self.b + size
        code[self.from_a + self.from_b] -= size
        code[self.from_b + self.ga] += size
        joined = "".join(map(table.__getitem__, code.tolist()))
        ends = np.r_[0, np.cumsum(lengths[code])][np.r_[0, np.cumsum(self.n_a + self.n_b)]].tolist()
        return [joined[begin + 1:end] for begin, end in zip(ends, ends[1:])]

    def links(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``wanted``, a * size of B + b, times) of the different links of the wanted windows, in order.

        A group of few links is written out; in a wide one the different ids of both sides are combined.
        """
        base = len(self.vb.bytes)
        span = base * len(self.va.bytes)
        place = np.full(len(self.cut), -1, np.int64)
        place[wanted] = np.arange(len(wanted))
        of_group = place[np.searchsorted(self.cut, np.arange(len(self.ga)))]
        p, q = self.ga - self.from_a, self.gb - self.from_b
        mine = of_group >= 0
        few = np.flatnonzero(mine & (p * q <= WRITTEN_OUT))
        many = (p * q)[few]
        at = np.repeat(few, many)
        step = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        keys = [of_group[at] * span + self.a[self.from_a[at] + step // q[at]].astype(np.int64) * base
                + self.b[self.from_b[at] + step % q[at]]]
        times = [np.ones(len(at), np.int64)]
        for g in np.flatnonzero(mine & (p * q > WRITTEN_OUT)).tolist():
            ids_a, n_a = np.unique(self.a[self.from_a[g]:self.ga[g]], return_counts=True)
            ids_b, n_b = np.unique(self.b[self.from_b[g]:self.gb[g]], return_counts=True)
            keys.append((of_group[g] * span + ids_a.astype(np.int64)[:, None] * base + ids_b).ravel())
            times.append((n_a[:, None] * n_b).ravel())
        key, time = np.concatenate(keys), np.concatenate(times)
        order = np.argsort(key, kind="stable")
        key, time = key[order], time[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        summed = np.add.reduceat(time, first) if len(key) else time
        return key[first] // span, key[first] % span, summed


def _spells(v: Vocabulary, ids: np.ndarray, many: np.ndarray, whole: list[bytes]) -> np.ndarray:
    """For each text, whether the bytes of its tokens are the given ones."""
    joined = b"".join(map(v.bytes.__getitem__, ids.tolist()))
    ends = np.r_[0, np.cumsum(v.lengths[ids])][np.r_[0, np.cumsum(many)]].tolist()
    return np.fromiter((joined[x:y] == w for x, y, w in zip(ends, ends[1:], whole)), bool, len(whole))


class Chunk:
    """Windows known so far and the pairs they link; parts known so far with their digest text, sums and windows."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.pair: dict[int, int] = {}
        self.base = 1  # a pair is a * base + b
        self.cuts, self.pairs, self.times = array("q", [0]), array("i"), array("q")
        self.docs = np.zeros(0, np.int64)  # for each pair, documents that link it
        self.size = 0
        self.part: dict[str, int] = {}
        self.part_text: list[str] = []
        self.part_sums = array("q")  # for each part: tokens of A and B, groups, links, and whether it is sound
        self.part_cuts, self.part_windows = array("q", [0]), array("i")

    def _number_windows(self, aligned: Aligned) -> list[int]:
        """The number of each window; the links of those not met before are worked out together."""
        numbers, fresh = [], []
        for at, (key, *_) in enumerate(aligned.windows()):
            number = self.number.get(key)
            if number is None:
                number = self.number[key] = len(self.number)
                fresh.append(at)
            numbers.append(number)
        place, pairs, times = aligned.links(np.array(fresh, np.int64))
        self.base = len(aligned.vb.bytes)
        different, back = np.unique(pairs, return_inverse=True)
        known = np.fromiter((self.pair.setdefault(p, len(self.pair)) for p in different.tolist()), np.int32, len(different))
        ends = np.searchsorted(place, np.arange(1, len(fresh) + 1)) + len(self.pairs)
        self.cuts.frombytes(ends.astype(np.int64).tobytes())
        self.pairs.frombytes(known[back].tobytes())
        self.times.frombytes(times.tobytes())
        return numbers

    def _learn_parts(self, parts: list[str], byte_file: str, piece_file: str) -> None:
        aligned = Aligned(parts, byte_file, piece_file)
        numbers = self._number_windows(aligned)
        of_group = np.searchsorted(np.cumsum(aligned.n_a), aligned.ga)
        groups, links = (np.zeros(len(parts), np.int64) for _ in range(2))
        np.add.at(groups, of_group, 1)
        np.add.at(links, of_group, (aligned.ga - aligned.from_a) * (aligned.gb - aligned.from_b))
        added = np.stack([aligned.n_a, aligned.n_b, groups, links, aligned.sound], axis=1)
        ends = np.searchsorted(aligned.doc, np.arange(1, len(parts) + 1)) + len(self.part_windows)
        self.part.update(zip(parts, range(len(self.part), len(self.part) + len(parts))))
        self.part_text += aligned.digest_texts()
        self.part_sums.frombytes(added.astype(np.int64).tobytes())
        self.part_windows.extend(numbers)
        self.part_cuts.frombytes(ends.astype(np.int64).tobytes())

    def linked(self) -> np.ndarray:
        """(a, b) of each pair."""
        keys = np.fromiter(self.pair, np.int64, len(self.pair))
        return np.stack([keys // self.base, keys % self.base], axis=1).astype(np.int32)

    def add(self, texts: list[str], byte_file: str, piece_file: str, together: int) -> tuple[np.ndarray, list[str], list[bytes]]:
        """(tokens of A and B, groups, links) of each text, digests and window numbers."""
        cut = tokenizers(byte_file, piece_file)[-1]
        split = [parts_of(t, cut) for t in texts]
        fresh = sorted(set().union(*split).difference(self.part)) if split else []
        for begin, end in _together(fresh, together):
            self._learn_parts(fresh[begin:end], byte_file, piece_file)
        many = np.array([len(x) for x in split], np.int64)
        part = np.fromiter(map(self.part.__getitem__, chain.from_iterable(split)), np.int64, int(many.sum()))
        ends = np.r_[0, np.cumsum(many)]
        of_part = np.frombuffer(self.part_sums, np.int64).reshape(-1, 5)
        added = np.stack([sums(of_part[part, i], ends) for i in range(5)], axis=1)
        sound = added[:, 4] == many  # all parts are; an empty text is one part that is not
        added[~sound] = 0
        cuts_of_part, windows_of_part = np.frombuffer(self.part_cuts, np.int64), np.frombuffer(self.part_windows, np.int32)
        mine = np.repeat(sound, many)  # places whose windows count
        doc_of, kept = np.repeat(np.arange(len(texts)), many)[mine], part[mine]
        at, length = _gather(cuts_of_part, kept)
        seen, doc = windows_of_part[at], np.repeat(doc_of, length)
        cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
        # documents of each pair: a document's different windows, then their different pairs
        both = _different(doc * len(self.number) + seen)
        at, length = _gather(np.frombuffer(self.cuts, np.int64), both % max(1, len(self.number)))
        found = _different(np.repeat(both // max(1, len(self.number)), length) * max(1, len(self.pair))
                           + np.frombuffer(self.pairs, np.int32)[at])
        counted = np.bincount(found % max(1, len(self.pair)), minlength=len(self.pair))
        counted[:len(self.docs)] += self.docs
        self.docs = counted
        digests = [
            hashlib.sha256(";".join([self.part_text[p] for p in part[a:b].tolist()]).encode()).hexdigest() if ok else ""
            for ok, a, b in zip(sound, ends, ends[1:])]
        stored = [seen[a:b].astype("<i4").tobytes() for a, b in zip(cuts, cuts[1:])]
        return added[:, :4], digests, stored


def _gather(cuts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the items of the given rows, one row after the other, and how many each has."""
    starts, many = cuts[rows], cuts[rows + 1] - cuts[rows]
    return np.repeat(starts - (np.cumsum(many) - many), many) + np.arange(many.sum()), many


def _different(values: np.ndarray) -> np.ndarray:
    """The different values in order. Sorting beats the hash table of np.unique here."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values.astype(np.int64))]
    return total[cuts[1:]] - total[cuts[:-1]]


def _together(texts: list[str], size_of_part: int) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= size_of_part:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


_ROWS = ("kind string, chunk long, doc_id {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "windows binary, idx int, a int, b int, n long, cuts binary, pairs binary, times binary")


def _chunk_rows(docs: DataFrame, byte_file: str, piece_file: str, sizes: Sizes) -> DataFrame:
    """Rows of three kinds: a document, a pair of a chunk, and the windows of a chunk."""
    doc_type = dict(docs.dtypes)["doc_id"]
    names = [c.split()[0] for c in _ROWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {name: pa.int64() for name in ("chunk", "n_a", "n_b", "n_groups", "n_links", "n")}
        kinds |= {name: pa.int32() for name in ("idx", "a", "b")} | {name: pa.string() for name in ("kind", "groups_sha256")}
        kinds |= {name: pa.binary() for name in ("windows", "cuts", "pairs", "times")}
        ids_type = None

        def rows(size: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array(columns[c], kinds[c]) if c in columns and not isinstance(columns[c], pa.Array)
                else columns.get(c, pa.nulls(size, ids_type if c == "doc_id" else kinds.get(c))) for c in names], names=names)

        def close(chunk: Chunk, number: int) -> Iterator[pa.RecordBatch]:
            some = np.flatnonzero(chunk.docs)  # a part may be sound in texts that are not
            n = len(some)
            if n:
                both = chunk.linked()[some]
                yield rows(n, kind=["pair"] * n, chunk=np.full(n, number), idx=some.astype(np.int32), a=both[:, 0],
                           b=both[:, 1], n=chunk.docs[some])
            yield rows(1, kind=["table"], chunk=[number], cuts=[chunk.cuts.tobytes()], pairs=[chunk.pairs.tobytes()],
                       times=[chunk.times.tobytes()])

        number, chunk = TaskContext.get().partitionId() << 32, None
        for some in (b.slice(i, AT_ONCE) for b in batches for i in range(0, b.num_rows, AT_ONCE)):
            ids, texts = some.column(0), [t or "" for t in some.column(1).to_pylist()]
            ids_type = ids.type
            for begin, end in _together(texts, 8 * sizes.together):
                chunk = chunk or Chunk()
                added, digests, stored = chunk.add(texts[begin:end], byte_file, piece_file, sizes.together)
                n = end - begin
                yield rows(n, kind=["doc"] * n, chunk=np.full(n, number), doc_id=ids.slice(begin, n), n_a=added[:, 0],
                           n_b=added[:, 1], n_groups=added[:, 2], n_links=added[:, 3], groups_sha256=digests, windows=stored)
                chunk.size += sum(map(len, texts[begin:end]))
                if chunk.size >= sizes.chunk or max(len(chunk.number), len(chunk.part)) >= sizes.windows:
                    yield from close(chunk, number)
                    number, chunk = number + 1, None
        if chunk:
            yield from close(chunk, number)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, _ROWS.format(doc_type))


def _totals(pairs: DataFrame) -> DataFrame:
    """a, b, n (documents that link them) and whether no other b has more with this a. An a has at most B's vocabulary of rows."""
    counted = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))
    return materialize(
        counted.withColumn("best", F.col("n") == F.max("n").over(W.partitionBy("a"))), "pair-totals")


def _add_up(key, docs: pa.Table, known: pa.Table) -> pa.Table:
    """Sums of one chunk's documents from the totals of its pairs, some documents at a time."""
    give_back()
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    table = known.filter(pc.is_valid(known.column("cuts")))
    pairs = known.filter(pc.is_valid(known.column("idx")))
    idx = pairs.column("idx").to_numpy()
    cuts, of, times = (np.frombuffer(table.column(c)[0].as_py(), t) for c, t in (("cuts", "q"), ("pairs", "i"), ("times", "q")))
    total, best = (np.zeros(int(of.max(initial=-1)) + 1, np.int64) for _ in range(2))
    total[idx], best[idx] = pairs.column("n").to_numpy(), pairs.column("best").to_numpy(zero_copy_only=False)
    n_best, count_sum = (sums(times * x[of], cuts) for x in (best, total))
    stored = docs.column("windows").combine_chunks()
    ends = np.r_[0, np.cumsum(pc.binary_length(stored).to_numpy(zero_copy_only=False))] // 4
    found = np.zeros((2, len(stored)), np.int64)
    begin = 0
    while begin < len(stored):
        # one document at least, however long
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + ADDED_AT_ONCE, side="right")) - 1)
        seen = np.frombuffer(b"".join(stored.slice(begin, end - begin).to_pylist()), "<i4")
        at = ends[begin:end + 1] - ends[begin]
        found[:, begin:end] = sums(n_best[seen], at), sums(count_sum[seen], at)
        begin = end
    return pa.table({
        **{c: docs.column(c) for c in keep}, "n_best": pa.array(found[0], pa.int64()),
        "count_sum": pa.array(found[1], pa.int64()), "groups_sha256": docs.column("groups_sha256")})


def _stored_chunks(docs: DataFrame, byte_file: str, piece_file: str, sizes: Sizes) -> DataFrame:
    return materialize(_chunk_rows(docs, byte_file, piece_file, sizes), "aligned-chunks")


def align_documents(docs: DataFrame, byte_file: str, piece_file: str, sizes: Sizes = Sizes()) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    chunks = _stored_chunks(docs, byte_file, piece_file, sizes)
    pairs = chunks.where("kind = 'pair'").select("chunk", "idx", "a", "b", "n")
    totals = _totals(pairs).withColumnRenamed("n", "total")
    none = [F.lit(None).cast("binary").alias(c) for c in ("cuts", "pairs", "times")]
    known = pairs.drop("n").join(totals, ["a", "b"]).select("chunk", "idx", F.col("total").alias("n"), "best", *none)
    tables = chunks.where("kind = 'table'").select(
        "chunk", F.lit(None).cast("int").alias("idx"), F.lit(None).cast("long").alias("n"),
        F.lit(None).cast("boolean").alias("best"), "cuts", "pairs", "times")
    rows = chunks.where("kind = 'doc'").select(
        F.col("chunk").alias("of"), "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "windows")
    doc_type = dict(docs.dtypes)["doc_id"]
    return rows.groupBy("of").cogroup(known.unionByName(tables).groupBy("chunk")).applyInArrow(
        lambda key, left, right: _add_up(key, left, right),
        f"doc_id {doc_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def id_pairs(docs: DataFrame, byte_file: str, piece_file: str, sizes: Sizes = Sizes()) -> DataFrame:
    """a, b, n, best: every linked pair of ids, the number of documents that link it, and whether it is a's most frequent."""
    chunks = _stored_chunks(docs, byte_file, piece_file, sizes)
    return _totals(chunks.where("kind = 'pair'").select("a", "b", "n"))


def token_groups(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """doc_id and groups, an array of (a, b): the ids of A and B that stand for the same bytes, in text order."""
    doc_type = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in _together(texts, Sizes().together):
                aligned = Aligned(texts[begin:end], byte_file, piece_file)
                found: list[list[dict]] = [[] for _ in range(begin, end)]
                for doc, (_, *window) in zip(aligned.doc.tolist(), aligned.windows()):
                    found[doc] += [{"a": a, "b": b} for a, b in aligned.groups(*window)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), pa.array(found, kind)], names=["doc_id", "groups"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {doc_type}, groups array<struct<a:array<int>,b:array<int>>>")
