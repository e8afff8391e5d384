"""Phrases whose words keep together, mined from all texts by vertical partitioning of their suffixes.

The words from a place to the end of its piece, at most ``longest``, are the suffix there. The suffix tree of a corpus,
cut off at that depth, has a node for each phrase, and the leaves below a node are its occurrences. The tree is never built as a
whole:

1. Texts are cut into chunks of word numbers with a word list each, written once. The word lists are dealt by word, one packed
   row for each chunk and bucket of words, and counted; only words that occur often enough can be in a candidate, the others
   end a suffix. The kept words get dense numbers, which go back the same way, and each chunk is written once in these numbers.
2. Words are packed, in order, into groups of less than two budgets of occurrences. A word with more than one budget is
   lengthened: its prefixes of two words are dealt by hash into as many groups as it has budgets. Those that can be more than a
   budget themselves, as each of their words is, are counted over all chunks, and those that are get lengthened in turn, up to the
   full depth, where equal suffixes are one row per chunk. Chunks stay where they are for this; the few prefixes come to them.
3. Each chunk sends its suffixes, equal ones merged, to the groups of their prefixes. A group is one task: it sorts its
   suffixes, which lays its subtrees side by side, and reads the count of every node from the totals of its leaves. Nodes
   above a group's prefixes were counted when these were lengthened.

Then scores: every cut of a candidate meets the counts of its two parts by joins, in decimals of 38 digits. A
candidate inside a longer one with (nearly) its count goes; it is enough to look at candidates longer by one word, as
counts never grow with length. No group is larger than that however frequent a word, a pair or a passage is. A text is in one
chunk, so a text longer than a chunk makes one of its own length.

Defined cases: a null or empty text has no words; a null lang is ``und``, together with that lang's own rows; every row counts,
repeated ones too; words are compared as bytes after A-Z are lower-cased; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderweave.operators.ordering import running_total
from orderweave.session import materialize

MIN_COUNT, LONGEST, TOP, NO_LANG = 100, 5, 2000, "und"
#: A candidate goes if a longer one around it has this percentage of its occurrences.
PERCENT = 100
#: Bytes that end a piece, and bytes between words.
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"


STRETCH = 1 << 22


class Sizes(NamedTuple):
    """Words of a chunk, occurrences of the prefixes of a group, and listed words of a bucket."""

    chunk: int = 1 << 21
    budget: int = 1 << 20
    bucket: int = 1 << 19


_LOWER = bytes(
    10 if b in ENDS else 32 if b in GAPS else b + 32 if 65 <= b <= 90 else b for b in range(256))


class _Numbers(dict):
    """Words numbered as they come; 0 is the empty string between two gaps, 1 the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Chunk:
    def __init__(self) -> None:
        self.words = _Numbers({b"": 0, b"\n": 1})
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str) -> None:
        data = text.encode("utf-8", "surrogatepass").translate(_LOWER).replace(b"\n", b" \n ") + b" \n"
        begin = 0
        while begin < len(data):  # split a bounded stretch at a time
            end = data.find(b" ", begin + STRETCH)
            end = len(data) if end < 0 else end
            ids = np.fromiter(map(self.words.__getitem__, data[begin:end].split(b" ")), np.int32)
            ids = ids[ids != 0]
            self.parts.append(ids)
            self.size += len(ids)
            begin = end + 1

    def ids(self) -> np.ndarray:
        """Word numbers from 0, -1 at the end of a piece."""
        return np.maximum(np.concatenate(self.parts) - 2, -1)


def _zipped(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unzipped(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""


def pack(numbers: np.ndarray, kind: str = "<i4") -> bytes:
    """Numbers as zipped planes: all lowest bytes, then all next ones; the high ones are mostly equal."""
    raw = np.ascontiguousarray(numbers, kind)
    return _zipped(raw.view(np.uint8).reshape(-1, raw.itemsize).T.tobytes())


def unpack(data: bytes, kind: str = "<i4") -> np.ndarray:
    planes = np.frombuffer(_unzipped(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


_CHUNKS = "chunk long, lang string, total long, listed long, words binary, counts binary, ids binary"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _chunk_rows(docs: DataFrame, size: int) -> DataFrame:
    """A row for each chunk: its word list with counts, and its word numbers. A chunk has one language."""
    def close(chunk: Chunk, lang: str, number: int) -> pa.RecordBatch:
        ids = chunk.ids()
        words = list(chunk.words)[2:]
        counts = np.bincount(ids[ids >= 0], minlength=len(words))
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([lang], pa.string()), pa.array([int(counts.sum())], pa.int64()),
            pa.array([len(words)], pa.int64()), pa.array([_zipped(b"\n".join(words))], pa.binary()),
            pa.array([pack(counts, "<i8")], pa.binary()), pa.array([pack(ids)], pa.binary())], names=_names(_CHUNKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, open_chunks, held = TaskContext.get().partitionId() << 32, {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                chunk = open_chunks.setdefault(lang, Chunk())
                before = chunk.size
                chunk.add(text)
                held += chunk.size - before
                if held >= size:  # all languages together are bounded
                    for name, full in open_chunks.items():
                        yield close(full, name, number)
                        number += 1
                    open_chunks, held = {}, 0
        for name, rest in open_chunks.items():
            yield close(rest, name, number)
            number += 1

    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG))
    return docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(run, _CHUNKS)


def _rows_equal_above(matrix: np.ndarray) -> np.ndarray:
    """For each row of a sorted matrix, how many leading columns it shares with the row before; 0 for the first."""
    same = np.logical_and.accumulate(matrix[1:] == matrix[:-1], axis=1).sum(axis=1)
    return np.r_[0, same] if len(matrix) else np.zeros(0, np.int64)


def merged(matrix: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one, in order, with the sum of their counts."""
    if not len(matrix):
        return matrix, counts
    order = np.lexsort(matrix.T[::-1])
    matrix, counts = matrix[order], counts[order]
    first = np.flatnonzero(_rows_equal_above(matrix) < matrix.shape[1])
    return matrix[first], np.add.reduceat(counts, first)


def nodes(matrix: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``depth`` words of sorted suffixes that have as many, once each, and the totals of the leaves below."""
    shared = _rows_equal_above(matrix)
    first = np.flatnonzero(shared < depth)
    if not len(first):
        return matrix[:0, :depth], counts[:0]
    totals, tops = np.add.reduceat(counts, first), matrix[first, :depth]
    whole = tops[:, -1] >= 0
    return tops[whole], totals[whole]


def suffixes(words: np.ndarray, longest: int) -> np.ndarray:
    """A row for each place with at least two words ahead: the words there, -1 behind the end."""
    padded = np.concatenate([words, np.full(longest, -1, words.dtype)])
    starts = np.flatnonzero((padded[:len(words)] >= 0) & (padded[1:len(words) + 1] >= 0))
    out = np.stack([padded[starts + i] for i in range(longest)], axis=1)
    out[np.logical_or.accumulate(out < 0, axis=1)] = -1
    return out


def _rows_as_bytes(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows.astype("<i8")).view(f"V{8 * rows.shape[1]}").ravel()


def _hashed(rows: np.ndarray) -> np.ndarray:
    """A 64-bit number of each row; it only deals rows to groups."""
    out = np.full(len(rows), 0x9E3779B97F4A7C15, np.uint64)
    for column in rows.T:
        out = (out ^ column.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


_DEALT = "bucket long, chunk long, lang string, words binary, counts binary, idx binary"


def _dealt(buckets: int):
    """A chunk's word list as a row for each bucket; ``idx`` are the words' numbers in the chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, lang, words, counts in zip(*(batch.column(i).to_pylist() for i in range(4))):
                words = _unzipped(words).split(b"\n") if words[:8] != bytes(8) else []
                if not words:
                    continue
                counts = unpack(counts, "<i8")
                bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                out = [(int(bucket[idx[0]]), chunk, lang, _zipped(b"\n".join(map(words.__getitem__, idx.tolist()))),
                        pack(counts[idx], "<i8"), pack(idx)) for idx in np.split(order, cuts)]
                kinds = [pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_names(_DEALT))

    return run


_COUNTED = "bucket long, lang string, word string, n long, local long, chunk long, idx binary, locals binary"


def _counted(least: int):
    """The words of a bucket that occur often enough, numbered in the bucket; and for each chunk where it has which of them."""
    def run(key, table):
        rows = list(zip(*(table.column(c).to_pylist() for c in ("lang", "chunk", "words", "counts", "idx"))))
        bucket, out, before = key[0].as_py(), [], 0
        for lang in sorted({r[0] for r in rows}):
            mine = [r for r in rows if r[0] == lang]
            numbers = _Numbers()
            lists = [np.array([numbers[w] for w in _unzipped(r[2]).split(b"\n")]) for r in mine]
            n = np.zeros(len(numbers), np.int64)
            for at, r in zip(lists, mine):
                n[at] += unpack(r[3], "<i8")  # a list has a word once
            often = n >= least
            local = np.cumsum(often) - 1 + before
            before += int(often.sum())
            out += [(bucket, lang, w.decode("utf-8", "surrogatepass"), c, i, None, None, None)
                    for w, c, i, keep in zip(numbers, n.tolist(), local.tolist(), often.tolist()) if keep]
            for at, r in zip(lists, mine):
                keep = often[at]
                if keep.any():
                    out.append((bucket, None, None, None, None, r[1], pack(unpack(r[4])[keep]), pack(local[at[keep]], "<i8")))
        kinds = [pa.int64(), pa.string(), pa.string()] + [pa.int64()] * 3 + [pa.binary()] * 2
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 8, kinds)], names=_names(_COUNTED))

    return run


_ROUTES = "chunk long, idx binary, gids binary, parts binary, budgets binary"


def _routes(numbered: pa.Table, chunks: pa.Table) -> pa.Table:
    """A bucket's numbers sent back to the chunks: gid, part (-1: lengthened) and budgets (0: not lengthened) of each word."""
    order = np.argsort(numbered.column("local").to_numpy())
    gid, part, budgets = (numbered.column(c).fill_null(x).to_numpy()[order] for c, x in (("gid", -1), ("part", -1), ("budgets", 0)))
    out = []
    for chunk, idx, local in zip(*(chunks.column(c).to_pylist() for c in ("chunk", "idx", "locals"))):
        local = unpack(local, "<i8")
        out.append((chunk, idx, *(pack(x[local], "<i8") for x in (gid, part, budgets))))
    kinds = [pa.int64()] + [pa.binary()] * 4
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds)], names=_names(_ROUTES))


_PLACED = "chunk long, places binary, gids binary, parts binary, budgets binary"


def _placed(key, chunk: pa.Table, routes: pa.Table) -> pa.Table:
    """A chunk in numbers of its frequent words by ascending gid, -1 where others or ends of pieces are, one for a run of these."""
    out = []
    if len(chunk) and len(routes):
        ids = unpack(chunk.column("ids")[0].as_py())
        idx = np.concatenate([unpack(x) for x in routes.column("idx").to_pylist()])
        gid, part, budgets = (np.concatenate([unpack(x, "<i8") for x in routes.column(c).to_pylist()])
                              for c in ("gids", "parts", "budgets"))
        order = np.argsort(gid)
        own = np.full(int(max(ids.max(initial=-1), idx.max(initial=-1))) + 2, -1, np.int32)  # the last is the end of a piece
        own[idx[order]] = np.arange(len(order))
        places = own[ids]
        places = places[(places >= 0) | np.r_[True, places[:-1] >= 0]]
        out.append((key[0].as_py(), pack(places), *(pack(x[order], "<i8") for x in (gid, part, budgets))))
    kinds = [pa.int64()] + [pa.binary()] * 4
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds)], names=_names(_PLACED))


class Placed(NamedTuple):
    """A chunk: places as numbers of its words, the words' gids, parts and budgets, and its longer lengthened prefixes."""

    chunk: int
    places: np.ndarray
    gids: np.ndarray
    parts: np.ndarray
    budgets: np.ndarray
    longer: list[dict]

    def lengthened(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The prefixes of this level that are lengthened, and into how many groups each."""
        if level == 1:
            heavy = self.budgets > 0
            return self.gids[heavy].reshape(-1, 1), self.budgets[heavy]
        rows = [x for x in self.longer if len(x["prefix"]) == level]
        return (np.array([x["prefix"] for x in rows], np.int64).reshape(-1, level),
                np.array([x["budgets"] for x in rows], np.int64))


def _each_placed(batches: Iterator[pa.RecordBatch]) -> Iterator[Placed]:
    for batch in batches:
        for i in range(batch.num_rows):
            chunk, places, gids, parts, budgets, longer = (batch.column(c)[i].as_py() for c in range(6))
            yield Placed(chunk, unpack(places), *(unpack(x, "<i8") for x in (gids, parts, budgets)), longer or [])


def _route(chunk: Placed, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes, group, depth) of one chunk. The group's subtrees are complete from ``depth`` words on. Suffixes of a lengthened
    prefix of ``longest - 1`` words have the depth ``longest`` and no group, -1.
    """
    words = np.r_[chunk.gids, -1][chunk.places]
    matrix = suffixes(words, longest)
    ahead = np.r_[words[1:], -1]
    group = chunk.parts[chunk.places[(words >= 0) & (ahead >= 0)]]
    depth = np.ones(len(matrix), np.int64)
    for level in range(1, longest):
        prefixes, budgets = chunk.lengthened(level)
        if not len(prefixes):
            break
        # light prefixes of the level were dealt a level earlier; of the others, those that go on are dealt by one word more
        below = np.flatnonzero(depth == level)
        order = np.argsort(keys := _rows_as_bytes(prefixes))
        mine = _rows_as_bytes(matrix[below, :level])
        at = np.searchsorted(keys[order], mine).clip(max=len(keys) - 1) if len(mine) else np.zeros(0, np.int64)
        hit = keys[order][at] == mine
        below, at = below[hit], order[at[hit]]
        depth[below] = level + 1
        if level == longest - 1:
            group[below] = -1
            break
        bucket = _hashed(matrix[below, :level + 1]) % budgets[at].astype(np.uint64)
        group[below] = (_hashed(np.column_stack([matrix[below, :level], bucket.astype(np.int64)])) >> np.uint64(1)).astype(np.int64)
    return matrix, group, depth


_PREFIXES = "chunk long, prefix array<long>, n long"


def _lengthened(level: int, longest: int):
    """Each chunk's counts of the prefixes of ``level`` words below those that were lengthened. Only words with more than one
    budget make a prefix with more than one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _each_placed(batches):
            matrix, _, depth = _route(chunk, longest)
            matrix = matrix[depth == level][:, :level]
            matrix = matrix[np.isin(matrix, chunk.lengthened(1)[0]).all(axis=1)]
            rows, counts = merged(matrix, np.ones(len(matrix), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), chunk.chunk), pa.int64()), _lists(rows), pa.array(counts, pa.int64())],
                names=_names(_PREFIXES))

    return run


def _lists(matrix: np.ndarray) -> pa.Array:
    cuts = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(cuts, pa.array(matrix.astype(np.int64).ravel()))


_SENT = "part long, depth int, rows binary, counts binary, prefix array<long>, n long"


def _sent(longest: int, kind: str):
    """Each chunk's suffixes, equal ones merged, as one packed row for each group, word by word so that they compress.

    A prefix of ``longest - 1`` words that is still too frequent has no group: its leaves go by themselves, (prefix, n).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _each_placed(batches):
            out: list[tuple] = []
            matrix, group, depth = _route(chunk, longest)
            # behind a lengthened prefix there is nothing to count in a suffix that ends with it
            some = matrix[np.arange(len(matrix)), depth - 1] >= 0
            rows, counts = merged(np.column_stack([group[some], depth[some], matrix[some]]), np.ones(int(some.sum()), np.int64))
            cuts = np.flatnonzero(_rows_equal_above(rows[:, :2]) < 2)
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(rows)]):
                part, level = rows[a, :2].tolist()
                if part < 0:
                    out += [(None, level, None, None, r, n) for r, n in zip(rows[a:b, 2:].tolist(), counts[a:b].tolist())]
                else:
                    out.append((part, level, pack(rows[a:b, 2:].T.ravel(), kind), pack(counts[a:b]), None, None))
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=_names(_SENT))

    return run


def _subtree(longest: int, least: int, kind: str):
    """All nodes of a group's subtrees that occur often enough, from the prefixes' own depth down."""
    def run(table: pa.Table) -> pa.Table:
        depth = table.column("depth")[0].as_py()
        matrix = np.concatenate([unpack(r.as_py(), kind).reshape(longest, -1).T for r in table.column("rows")])
        counts = np.concatenate([unpack(c.as_py()) for c in table.column("counts")])
        matrix, counts = merged(matrix, counts.astype(np.int64))
        found, totals = [], []
        for k in range(max(2, depth), longest + 1):
            tops, sums = nodes(matrix, counts, k)
            often = sums >= least
            found.append(_lists(tops[often]))
            totals.append(sums[often])
        return pa.table({"prefix": pa.chunked_array(found, pa.list_(pa.int64())),
                         "n": pa.array(np.concatenate(totals), pa.int64())})

    return run


def _packed(counted: DataFrame, budget: int) -> DataFrame:
    """``part``: the group of a word; a stretch of ``budget`` occurrences holds less than two budgets. A word with more than one
    has no part but a number of ``budgets``."""
    light = running_total(counted.where(F.col("n") <= budget), ["gid"], "ahead", value=F.col("n")).select(
        "*", F.expr(f"ahead div {budget}").alias("part"), F.lit(None).cast("long").alias("budgets")).drop("ahead")
    return light.unionByName(counted.where(F.col("n") > budget).select(
        "*", F.lit(None).cast("long").alias("part"), _budgets_of(budget)))


def _budgets_of(budget: int) -> Column:
    return F.expr(f"n div {budget} + 1").alias("budgets")


def _beside(placed: DataFrame, longer: DataFrame | None) -> DataFrame:
    """Each chunk with its lengthened prefixes of two and more words. These are few, so that a chunk is rarely moved for them."""
    if longer is None:
        return placed.withColumn("longer", F.lit(None).cast("array<struct<prefix: array<long>, budgets: long>>"))
    by_chunk = materialize(longer.groupBy(F.col("chunk").alias("of")).agg(
        F.collect_list(F.struct("prefix", "budgets")).alias("longer")), "longer-by-chunk")
    return placed.join(by_chunk, F.col("chunk") == F.col("of"), "left").drop("of")


class Counts(NamedTuple):
    """``words``: gid, lang, word, n and more of frequent words; ``phrases``: prefix (gids), n; ``totals``: lang, total of all words."""

    words: DataFrame
    phrases: DataFrame
    totals: DataFrame


def count_phrases(docs: DataFrame, least: int = MIN_COUNT, longest: int = LONGEST, sizes: Sizes = Sizes()) -> Counts:
    """Counts of all phrases of 2 to ``longest`` words that occur at least ``least`` times within pieces."""
    stored = materialize(_chunk_rows(docs, sizes.chunk), "word-chunks")
    totals = materialize(stored.groupBy("lang").agg(F.sum("total").alias("total")).where("total > 0"), "lang-counts")
    buckets = (stored.agg(F.sum("listed")).first()[0] or 0) // sizes.bucket + 1
    counted = materialize(
        stored.select("chunk", "lang", "words", "counts").mapInArrow(_dealt(buckets), _DEALT)
        .groupBy("bucket").applyInArrow(_counted(least), _COUNTED), "word-counts")
    # frequent words get small numbers, which pack better
    words = materialize(running_total(
        counted.where("chunk IS NULL").select("bucket", "local", "lang", "word", "n", F.expr("-n").alias("less")),
        ["less", "lang", "word"], "gid").drop("less"), "frequent-words")
    kind = "<i4" if words.count() < 1 << 31 else "<i8"
    numbered = materialize(_packed(words, sizes.budget).select("bucket", "local", "gid", "part", "budgets"), "numbered-words")
    routes = numbered.groupBy("bucket").cogroup(
        counted.where("chunk IS NOT NULL").select("bucket", "chunk", "idx", "locals").groupBy("bucket")).applyInArrow(_routes, _ROUTES)
    placed = materialize(stored.select(F.col("chunk").alias("of"), "ids").groupBy("of").cogroup(
        routes.groupBy("chunk")).applyInArrow(_placed, _PLACED), "placed-chunks")
    phrases, level, longer = [], 2, None
    heavy = numbered.where("budgets IS NOT NULL")
    while level < longest and not heavy.isEmpty():
        own = materialize(_beside(placed, longer).mapInArrow(_lengthened(level, longest), _PREFIXES), "prefixes")
        heavy = materialize(own.groupBy("prefix").agg(F.sum("n").alias("n")).where(F.col("n") > sizes.budget), "heavy-prefixes")
        phrases.append(heavy.where(F.col("n") >= least))
        more = own.drop("n").join(heavy.select("prefix", _budgets_of(sizes.budget)), "prefix").select("chunk", "prefix", "budgets")
        longer = materialize(more if longer is None else longer.unionByName(more), "longer-prefixes")
        level += 1
    packed = _beside(placed, longer).mapInArrow(_sent(longest, kind), _SENT)
    if level == longest and not heavy.isEmpty():
        packed = materialize(packed, "suffixes")  # read twice
        phrases.append(packed.where("part IS NULL").groupBy("prefix").agg(F.sum("n").alias("n")).where(F.col("n") >= least))
    found = packed.where("part IS NOT NULL").select("part", "depth", "rows", "counts").groupBy("depth", "part").applyInArrow(
        _subtree(longest, least, kind), "prefix array<long>, n long")
    for more in phrases:
        found = found.unionByName(more)
    return Counts(words, materialize(found, "phrase-counts"), totals)


def _exact_score() -> str:
    """floor(1000 * a * n / (l * r)) in decimals; exact for counts below 10^17."""
    a, n, l, r = (f"CAST({c} AS DECIMAL(17,0))" for c in ("a", "total", "l", "r"))
    return f"(CAST(1000 AS DECIMAL(4,0)) * {a} * {n}) div ({l} * {r})"


def mine_phrases(docs: DataFrame, least: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, percent: int = PERCENT,
                 sizes: Sizes = Sizes()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best ``top`` phrases by their weakest cut."""
    words, phrases, totals = count_phrases(docs, least, longest, sizes)
    length = F.size("prefix")
    # a candidate whose count a longer one keeps
    inner = phrases.where(length > 2).select(
        F.explode(F.array(F.slice("prefix", F.lit(1), length - 1), F.slice("prefix", F.lit(2), length - 1))).alias("inner"), "n")
    around = inner.groupBy("inner").agg(F.max("n").alias("around"))
    kept = phrases.join(around, F.col("prefix") == F.col("inner"), "left").where(
        F.col("around").isNull() | (100 * F.col("around") < percent * F.col("n")))
    of = words.select(F.col("gid").alias("first"), "lang").join(totals, "lang")
    kept = materialize(kept.join(of, F.col("prefix")[0] == F.col("first")).select(
        "prefix", F.col("n").alias("a"), "lang", "total"), "candidates")

    counts = materialize(words.select(F.array("gid").alias("part"), F.col("n").alias("f")).unionByName(
        phrases.select(F.col("prefix").alias("part"), F.col("n").alias("f"))), "part-counts")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), length - 1)).alias("k")).select(
        "*", F.slice("prefix", F.lit(1), F.col("k")).alias("left"), F.slice("prefix", F.col("k") + 1, length).alias("right"))
    cuts = cuts.join(counts.select(F.col("part").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    weakest = materialize(
        cuts.withColumn("score", F.expr(_exact_score())).groupBy("prefix", "lang", "total", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")), "weakest-cuts")

    spelled = (
        weakest.select("prefix", F.posexplode("prefix").alias("at", "gid")).join(words.select("gid", "word"), "gid")
        .groupBy("prefix").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
        .select("prefix", F.array_join(F.transform("w", lambda w: w["word"]), " ").alias("phrase"))
    )
    order = W.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    return (
        weakest.join(spelled, "prefix").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
                F.col("cut.r").alias("r"), F.col("total").alias("n"), F.col("cut.score").alias("score"))
    )
