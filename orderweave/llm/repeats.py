"""Long repeated passages of a corpus, by the longest previous factor of every position.

A byte string of ``length`` bytes that starts at a position and also starts at an earlier one has a longest previous
factor of at least ``length``. In suffix order cut off at ``length`` bytes, equal strings are neighbours, and among them the
next smaller position of a suffix is its predecessor in text order. A position thus has an earlier match if it is not the first of
its neighbours, and a later match if it is not the last. ``keep="first"`` removes the bytes under later copies alone,
``keep="none"`` those under the first copy too.

One suffix array of the whole corpus would need all text in one place. So suffixes are compared only where they can be equal:

1. Every window of ``length`` bytes has an anchor, the smallest hash among the strings of half that length inside it. Equal windows
   have equal anchors at equal offsets, so only anchors whose string repeats are looked at again. About one byte in
   ``length / 4`` is an anchor.
2. Anchors whose whole surroundings (all windows they stand for) repeat are settled by counting, combined on the map side. That
   covers the inside of copies, whatever their number.
3. What is left are the ends of repeats. The windows there are put in order by (anchor string, window) and text position. Equal
   windows of one batch are merged before the shuffle, and an anchor with very many different surroundings is dealt out by
   window, so no hot passage lands in one task.

Windows and strings are compared by independent 64-bit hashes with random tables (the anchor's and the window's together).

Defined cases: matches never cross documents; a null or empty text, or one shorter than ``length``, loses nothing;
rows that repeat doc_id and text share one fate: both are whole copies, kept as the first if they are; null ids come
first; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweave.session import materialize, small_side

LENGTH = 400
#: Different surroundings of one anchor string that are compared in one group.
GROUP = 4096
#: Windows merged before the shuffle, and compared after it, at a time.
MERGED = 1 << 20
#: A longer text is hashed in stretches that overlap by a window less one byte.
STRETCH = 1 << 22

_random = np.random.default_rng(20240607)
TABLE = _random.integers(0, 1 << 64, 256, np.uint64)
BASE = int(_random.integers(0, 1 << 62)) * 2 + 1
INVERSE = pow(BASE, -1, 1 << 64)
LOW24 = np.uint64((1 << 24) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = {"up": _powers(BASE, 1 << 12), "down": _powers(INVERSE, 1 << 12)}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Hashed:
    """Hashes of all substrings of a byte string, each in one step."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        if n + 1 > len(_POWERS["up"]):
            size = 1 << (n + 1).bit_length()
            _POWERS["up"], _POWERS["down"] = _powers(BASE, size), _powers(INVERSE, size)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(TABLE[data] * _POWERS["up"][:n], out=self.sums[1:])

    def every(self, start: int, end: int, length: int) -> np.ndarray:
        """Of the strings of this length that start at start .. end-1."""
        return (self.sums[start + length:end + length] - self.sums[start:end]) * _POWERS["down"][start:end]

    def at(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * _POWERS["down"][starts]


def anchors(data: np.ndarray, length: int) -> list[np.ndarray]:
    """[key, surroundings, first, last]: an anchor for each run of windows (first .. last, by start) that it stands for."""
    half = length // 2
    n_windows = len(data) - length + 1
    if n_windows < 1:
        return [np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64)]
    if len(data) > STRETCH:
        step = STRETCH - length + 1
        parts = [(start, anchors(data[start:start + STRETCH], length)) for start in range(0, n_windows, step)]
        return [np.concatenate([found[i] + (start if i > 1 else found[i].dtype.type(0)) for start, found in parts])
                for i in range(4)]
    hashed = Hashed(data)
    keys = hashed.every(0, len(data) - half + 1, half)
    order = (_mix(keys) & ~LOW24) | np.arange(len(keys), dtype=np.uint64)  # equal hashes: the leftmost
    span = length - half + 1
    blocks = -(-len(order) // span)
    padded = np.full(blocks * span, ~np.uint64(0), np.uint64)
    padded[:len(order)] = order
    grid = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(behind[:n_windows], ahead[span - 1:span - 1 + n_windows]) & LOW24).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], n_windows] - 1
    place = place[first]
    around = _mix(hashed.at(first, last + length)) ^ _mix(
        ((place - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64))
    return [keys[place], around, first, last]


def _bytes_of(value) -> np.ndarray:
    return np.frombuffer((value.as_py() or "").encode("utf-8", "surrogatepass"), np.uint8)


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64), pa.int64())


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                found = [anchors(_bytes_of(x), length) for x in part.column(2)]
                rows = np.repeat(np.arange(part.num_rows), [len(f[0]) for f in found])
                key, around, first, last = (np.concatenate([f[i] for f in found]) for i in range(4))
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), _longs(key), _longs(around),
                     pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                    names=["id", "text_hash", "key", "around", "first", "last"])

    return docs.mapInArrow(run, "id long, text_hash long, key long, around long, first long, last long")


SPANS = "id long, text_hash long, lo long, hi long"


class Windows:
    """Windows gathered for ordering: value, document, place, and whether a copy is known already."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, values: np.ndarray, doc: int, places: np.ndarray, twice: bool | np.ndarray) -> None:
        n = len(values)
        self.parts.append((values, np.full(n, doc), places, np.broadcast_to(twice, n)))
        self.size += n

    def ordered(self, rank: np.ndarray):
        """Values in the order of their window hashes, equal ones by document rank and place; which are first and which last of them."""
        values, doc, place, twice = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((place, rank[doc], values))
        values, doc, place, twice = values[order], doc[order], place[order], twice[order]
        is_first = np.r_[True, values[1:] != values[:-1]]
        is_last = np.r_[is_first[1:], True]
        return values, doc, place, twice, is_first, is_last


def _copies(twice: np.ndarray, is_first: np.ndarray, is_last: np.ndarray, keep: str) -> np.ndarray:
    """Windows whose bytes go: those with an earlier match, and without ``keep`` those with a later one."""
    if keep == "first":
        return ~is_first
    known = np.logical_or.reduceat(twice, np.flatnonzero(is_first))[np.cumsum(is_first) - 1]
    return ~(is_first & is_last) | known


def _spans(doc: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, lo, hi) of the bytes under the given windows, one for each run of neighbouring windows."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    starts = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + 1)]) if len(doc) else []
    ends = np.r_[starts[1:], len(doc)] - 1 if len(doc) else []
    return doc[starts] if len(doc) else doc, place[starts] if len(doc) else place, (
        place[ends] + length if len(doc) else place)


ROWS = ("id long, text_hash long, lo long, hi long, key long, part long, places binary, windows binary, twice boolean")


def _window_rows(texts: DataFrame, length: int, keep: str) -> DataFrame:
    """From (id, text_hash, text, work): spans found inside a batch (lo, hi) and the windows to compare elsewhere."""
    def merged(docs: list[tuple], work: list[tuple]) -> pa.RecordBatch:
        ids = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0, docs[i][1]))
        rank = np.empty(len(docs), np.int64)
        rank[ids] = np.arange(len(docs))
        held = Windows()
        for n, (doc, key, parts, twice, first, values) in enumerate(work):
            held.add(values ^ _mix(np.array([key], np.int64).view(np.uint64)), n, first + np.arange(len(values)), twice)
        owner = np.array([w[0] for w in work])
        values, n, place, twice, is_first, is_last = held.ordered(rank[owner])
        gone = _copies(twice, is_first, is_last, keep)
        out: list[tuple] = []
        for d, lo, hi in zip(*_spans(owner[n[gone]], place[gone], length)):
            out.append((*docs[d], int(lo), int(hi), None, None, None, None, None))
        # one of equal windows goes on; it stands for a copy if there were several
        several = np.logical_or.reduceat(twice | ~is_first | ~is_last, np.flatnonzero(is_first))
        values, n, place = values[is_first], n[is_first], place[is_first]
        parts = np.array([w[2] for w in work])[n]
        part = (_mix(values) % parts.astype(np.uint64)).astype(np.int64)
        order = np.lexsort((place, several, part, n))
        values, n, place, part, several = values[order], n[order], place[order], part[order], several[order]
        cut = np.flatnonzero(np.r_[True, (n[1:] != n[:-1]) | (part[1:] != part[:-1]) | (several[1:] != several[:-1])])
        for a, b in zip(cut, np.r_[cut[1:], len(n)]):
            doc, key = work[n[a]][:2]
            out.append((*docs[doc], None, None, int(key), int(part[a]), place[a:b].astype("<i8").tobytes(),
                        values[a:b].astype("<u8").tobytes(), bool(several[a])))
        columns = list(zip(*out))
        kinds = [pa.int64()] * 6 + [pa.binary(), pa.binary(), pa.bool_()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["id", "text_hash", "lo", "hi", "key", "part", "places", "windows", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, work, size = [], [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                data = _bytes_of(batch.column(2)[i])
                hashed, base = None, 0
                for w in sorted(batch.column(3)[i].as_py(), key=lambda w: w["first"]):
                    if hashed is None or w["last"] + length > base + STRETCH:
                        base = w["first"]
                        hashed = Hashed(data[base:base + STRETCH])
                    values = hashed.every(w["first"] - base, w["last"] - base + 1, length)
                    work.append((len(docs), w["key"], w["parts"], w["twice"], w["first"], values))
                    size += len(values)
                docs.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py()))
                if size >= MERGED:
                    yield merged(docs, work)
                    docs, work, size = [], [], 0
        if work:
            yield merged(docs, work)

    return texts.mapInArrow(run, ROWS)


def _compare(rows: DataFrame, length: int, keep: str) -> DataFrame:
    """Spans under equal windows of different batches. Groups are whole in a task and taken a bounded number at a time."""
    def settled(held: list[tuple]) -> pa.RecordBatch:
        docs = sorted({h[:2] for h in held}, key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
        number = {d: i for i, d in enumerate(docs)}
        windows = Windows()
        for doc_id, text_hash, places, values, twice in held:
            windows.add(np.frombuffer(values, "<u8"), number[doc_id, text_hash], np.frombuffer(places, "<i8"), twice)
        _, doc, place, twice, is_first, is_last = windows.ordered(np.arange(len(docs)))
        gone = _copies(twice, is_first, is_last, keep)
        doc, lo, hi = _spans(doc[gone], place[gone], length)
        return pa.RecordBatch.from_arrays(
            [pa.array([docs[d][0] for d in doc], pa.int64()), pa.array([docs[d][1] for d in doc], pa.int64()),
             pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], names=["id", "text_hash", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, group = [], 0, None
        for batch in batches:
            for key, part, *row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if (key, part) != group and size >= MERGED:
                    yield settled(held)
                    held, size = [], 0
                group = key, part
                held.append(tuple(row))
                size += len(row[3]) // 8
        if held:
            yield settled(held)

    return (
        rows.select("key", "part", "id", "text_hash", "places", "windows", "twice").repartition("key", "part")
        .sortWithinPartitions("key", "part").mapInArrow(run, SPANS)
    )


def repeated_spans(docs: DataFrame, length: int = LENGTH, keep: str = "first") -> DataFrame:
    """id, text_hash, spans (array of lo, hi): bytes of each document to remove; overlaps are left as they are.

    ``docs`` has id, text_hash and text.
    """
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    if length < 16 or length % 2:
        raise ValueError("an even length of at least 16 bytes")
    found = materialize(_anchor_rows(docs, length), "anchors")
    repeated = materialize(
        found.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("n")).where("n > 1").select("k"), "repeated-anchors")
    again = materialize(found.join(repeated, F.col("key") == F.col("k")).drop("k"), "anchors-again")
    around = again.groupBy("key", "around").agg(
        F.count("*").alias("n"), F.min(F.struct("id", "text_hash", "first", "last")).alias("one"))
    around = materialize(around, "surroundings")

    # the inside of copies: the surroundings as a whole occur again
    copied = around.where("n > 1").select(
        F.col("key").alias("k"), F.col("around").alias("a"), F.col("one.id").alias("oid"),
        F.col("one.text_hash").alias("oh"), F.col("one.first").alias("of"), "n")
    copied = materialize(copied, "copied")
    # surroundings that very many places share are met without a shuffle where their number, which is counted, allows it:
    # there is at most one of them for each GROUP places. The others are groups of at most GROUP rows.
    often = small_side(copied.where(F.col("n") > GROUP), "often-copied")
    same = (F.col("key") == F.col("k")) & (F.col("around") == F.col("a"))
    inside = again.join(often, same).unionByName(
        again.join(often, same, "left_anti").join(copied.where(F.col("n") <= GROUP), same))
    if keep == "first":
        inside = inside.where(~(
            F.col("id").eqNullSafe(F.col("oid")) & (F.col("text_hash") == F.col("oh")) & (F.col("first") == F.col("of"))))
    inside = inside.select("id", "text_hash", F.col("first").alias("lo"), (F.col("last") + length).alias("hi"))

    # the ends: different surroundings of one anchor string, each read at one of its places
    ends = around.groupBy(F.col("key").alias("k")).agg(
        F.count("*").alias("m"), F.min("n").alias("least")).where("m > 1")
    if keep == "none":
        ends = ends.where("least = 1")  # else all of them are copies already
    ends = materialize(ends.select("k", F.ceil(F.col("m") / GROUP).alias("parts")), "ends")
    work = around.join(ends, F.col("key") == F.col("k")).select(
        F.col("one.id").alias("wid"), F.col("one.text_hash").alias("wh"),
        F.struct(F.col("one.first").alias("first"), F.col("one.last").alias("last"), "key", "parts",
                 (F.col("n") > 1).alias("twice")).alias("w"))
    work = materialize(work.groupBy("wid", "wh").agg(F.collect_list("w").alias("work")), "work")
    texts = docs.join(work, F.col("id").eqNullSafe(F.col("wid")) & (F.col("text_hash") == F.col("wh"))).select(
        "id", "text_hash", "text", "work")
    rows = materialize(_window_rows(texts, length, keep), "windows")
    spans = (
        inside.union(rows.where("lo IS NOT NULL").select("id", "text_hash", "lo", "hi"))
        .union(_compare(rows.where("lo IS NULL"), length, keep))
    )
    return materialize(spans.groupBy("id", "text_hash").agg(
        F.collect_list(F.struct("lo", "hi")).alias("spans")), "repeats")


def with_identity(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")


def _cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    spans = spans.select(F.col("id").alias("sid"), F.col("text_hash").alias("sh"), "spans")
    return docs.join(spans, F.col("id").eqNullSafe(F.col("sid")) & (F.col("text_hash") == F.col("sh")), "left").select(
        "id", "text", "spans")


def _kept(data: np.ndarray, spans: list[dict] | None) -> tuple[np.ndarray, int]:
    """Mask of the bytes that stay, and the number of maximal removed runs."""
    steps = np.zeros(len(data) + 1, np.int64)
    if spans:
        np.add.at(steps, [s["lo"] for s in spans], 1)
        np.add.at(steps, [s["hi"] for s in spans], -1)
    gone = np.cumsum(steps[:-1]) > 0
    return ~gone, int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(data) else 0


def repeat_digest(docs: DataFrame, length: int = LENGTH, keep: str = "first") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the hash of the remaining bytes of every document."""
    named = with_identity(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                data, spans = _bytes_of(text), spans.as_py()
                if not spans:
                    rows.append((len(data), 0, 0, hashlib.sha256(data).hexdigest()))
                    continue
                mask, runs = _kept(data, spans)
                kept = data[mask]
                rows.append((len(data), len(data) - len(kept), runs, hashlib.sha256(kept.tobytes()).hexdigest()))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()])],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _cut(named, repeated_spans(named, length, keep)).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "first") -> DataFrame:
    """doc_id and the text without its repeated bytes; a character cut in two is dropped whole."""
    named = with_identity(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                data = _bytes_of(text)
                kept = data[_kept(data, spans.as_py())[0]].tobytes().decode("utf-8", "ignore")
                texts.append(kept if text.is_valid else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return _cut(named, repeated_spans(named, length, keep)).mapInArrow(run, "doc_id long, text string")
