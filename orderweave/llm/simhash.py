"""SimHash near-duplicates with an inverted index on the bytes of the fingerprint.

Two 64-bit fingerprints that differ in at most ``max_bits`` bits share at least ``8 - max_bits`` of their eight
positional bytes. Candidate pairs come from an inverted index on positional bytes, the bytes they share are tallied,
pairs below the guaranteed minimum are dropped, and the rest is verified by its bit distance.

A list for a single byte would hold one fingerprint in 256, so its pairs would grow with the square of the input. The
index therefore holds byte *triples* at fixed positions: 20 triples are enough for every set of four positions to contain one
(`TRIPLES`), so no pair that shares four bytes is lost. Smaller limits reuse the same triples; larger ones are refused.

Only different fingerprints are indexed, so exact copies cost nothing here. A list longer than ``TILE`` is cut into
blocks, and pairs of blocks become tasks of their own. Tasks return the links as spanning trees, never as all pairs.

Defined cases: a text without words (null, empty, white space) has fingerprint zero and is linked like any other; a
text with fewer words than a shingle is one shingle; ties and repeated rows get the same class; a null doc_id is carried
but names no class as long as the class has another id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweave.llm.components import components, flatten, join_trees
from orderweave.session import materialize

#: Fingerprints of one list that one task compares with each other.
TILE = 1024

#: Turan's cover: three groups of positions, and every triple inside one group or with two in one group and one in
#: the next. Any four of the eight positions contain one of them.
GROUPS = ((0, 1, 2), (3, 4, 5), (6, 7))
TRIPLES = [t for g in GROUPS for t in combinations(g, 3)] + [
    tuple(sorted((*pair, one))) for i, g in enumerate(GROUPS) for pair in combinations(g, 2)
    for one in GROUPS[(i + 1) % len(GROUPS)]]

#: For each positional byte value, its eight bits from the highest.
BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)
POSITION = (np.arange(8) * 256)[None, :]


def fingerprint(text: str | None, words: int) -> int:
    """64 bits; a bit is set if it is set in over half the hashes of the shingles, repeats included."""
    import xxhash

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII only: A-Z, and the six spaces
    if not parts:
        return 0
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    width = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], 42) for s, e in zip(starts, ends[width - 1:].tolist())), ">u8", len(parts) - width + 1)
    tally = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + POSITION).ravel(), minlength=2048).reshape(8, 256)
    ones = (2 * (tally @ BITS).ravel() > len(hashes)).astype(np.uint8)
    return int(np.packbits(ones).view(">u8")[0])


def fingerprints(docs: DataFrame, words: int, id_column: str = "doc_id", text_column: str = "text",
                 others: tuple[str, ...] = ()) -> DataFrame:
    """(id_column, others, fp long): the 64 bits as a signed number."""
    kept = (id_column, *others)
    out = docs.select(*kept, F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(x.as_py(), words) for x in batch.column(len(kept))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(values.view(np.int64), pa.int64())],
                names=[*kept, "fp"])

    return docs.select(*kept, text_column).mapInArrow(run, out)


def _postings(distinct: DataFrame) -> DataFrame:
    """(key, fp): one row for each triple of positions; the key holds the triple's number and its three bytes."""
    def byte(position: int):
        return F.shiftright(F.col("fp"), 8 * position).bitwiseAND(F.lit(255))

    keys = [
        F.lit(n << 24).cast("long").bitwiseOR(F.shiftleft(byte(a), 16)).bitwiseOR(F.shiftleft(byte(b), 8))
        .bitwiseOR(byte(c)) for n, (a, b, c) in enumerate(TRIPLES)]
    return distinct.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _tiles(postings: DataFrame, tile: int) -> DataFrame:
    """(key, lo, hi, fp): long lists are cut into blocks, and each row goes to all pairs of blocks of its own."""
    long_lists = (
        postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > tile)
        .select(F.col("key").alias("k"), F.ceil(F.col("n") / tile).cast("int").alias("blocks"))
    )
    long_lists = materialize(long_lists, "long-lists")
    dealt = postings.join(long_lists, F.col("key") == F.col("k"), "left").withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    return dealt.select("key", "fp", "own", other.alias("other")).select(
        "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")


def _forest(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each run of equal keys, as trees. Pairs are compared at distance 1, 2, ... along the runs."""
    n = len(fps)
    label = np.arange(n)
    starts = np.flatnonzero(np.r_[True, np.any(keys[1:] != keys[:-1], axis=1)]) if n else np.zeros(0, int)
    end_of = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))
    alive = np.arange(n)
    step = 1
    while True:
        alive = alive[alive + step < end_of[alive]]
        if not alive.size:
            break
        differ = fps[alive] ^ fps[alive + step]
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        alive_pairs = shared >= 8 - max_bits
        near = alive[alive_pairs][np.bitwise_count(differ[alive_pairs]) <= max_bits]
        join_trees(label, near, near + step)
        step += 1
    flatten(label)
    hung = np.flatnonzero(label != np.arange(n))
    return fps[hung], fps[label[hung]]


def fingerprint_links(distinct: DataFrame, max_bits: int, tile: int = TILE) -> DataFrame:
    """(a, b): trees over the different fingerprints ``fp`` that span all links of at most ``max_bits`` bits."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the index guarantees four shared bytes only up to four bits")
    tiles = _tiles(_postings(distinct), tile)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f = np.zeros((0, 3), np.int64), np.zeros(0, np.uint64)

        def links(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            a, b = _forest(k, f, max_bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(x.view(np.int64), pa.int64()) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            k = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
            held_k = np.concatenate([held_k, k])
            held_f = np.concatenate([held_f, batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64).view(
                np.uint64)])
            if not len(held_k):
                continue
            cut = len(held_k) - int((held_k == held_k[-1]).all(axis=1)[::-1].argmin() or len(held_k))
            if cut > 0:  # the last list may go on in the next batch
                yield links(held_k[:cut], held_f[:cut])
                held_k, held_f = held_k[cut:], held_f[cut:]
        if len(held_k):
            yield links(held_k, held_f)

    return (
        tiles.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
        .select("key", "lo", "hi", "fp").mapInArrow(run, "a long, b long")
    )


def simhash_classes(docs: DataFrame, words: int, max_bits: int, id_column: str = "doc_id", text_column: str = "text",
                    others: tuple[str, ...] = (), tile: int = TILE) -> DataFrame:
    """(id, others, fp, component): one row per document; component is the smallest id that can be reached by links."""
    marked = materialize(fingerprints(docs, words, id_column, text_column, others), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min(id_column).alias("first")), "distinct-fingerprints")
    found = components(fingerprint_links(distinct.select("fp"), max_bits, tile))
    in_class = distinct.join(found, distinct.fp == found.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    in_class = materialize(in_class, "fingerprint-classes")
    least = materialize(in_class.groupBy("root").agg(F.min("first").alias("component")), "class-ids")
    named = materialize(
        in_class.join(least, "root").select(F.col("fp").alias("of"), "component"), "class-of-fingerprint")
    return marked.join(named, marked.fp == named.of).select(id_column, *others, "fp", "component")


def keep_first(docs: DataFrame, words: int, max_bits: int) -> DataFrame:
    """One document of each class stays, the one with the smallest doc_id; of rows that repeat its id, one stays.

    Of a class that has no id at all, one document stays for each fingerprint.
    """
    narrow = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("__text"))
    classes = simhash_classes(narrow, words, max_bits, others=("__text",))
    first = classes.where(F.col("doc_id").eqNullSafe(F.col("component"))).groupBy(
        "doc_id", F.when(F.col("doc_id").isNull(), F.col("fp")).alias("fp"), "__text").agg(F.count("*").alias("n"))
    kept = materialize(
        first.groupBy(F.col("doc_id").alias("__kept"), "fp").agg(F.min(F.struct("__text", "n")).alias("one"))
        .select("__kept", F.col("one.__text").alias("__of"), F.col("one.n").alias("__n")), "kept")
    joined = docs.withColumn("__text", F.xxhash64(F.coalesce("text", F.lit("")))).join(
        kept, F.col("doc_id").eqNullSafe(F.col("__kept")) & (F.col("__text") == F.col("__of")))
    single = joined.where("__n = 1").select(*docs.columns)
    if not kept.where("__n > 1").head(1):
        return single
    return single.union(
        joined.where("__n > 1").select(*docs.columns, "__text").dropDuplicates(["doc_id", "__text"]).drop("__text"))
