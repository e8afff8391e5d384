"""Token ids in directly addressable codes: any token can be read without decoding a block.

An id is split into chunks of eight bits. Level 0 holds the lowest chunk of every id; a level's continuation bitmap says
which of its ids go on in the next level, and a rank directory (ones before every 512th bit) gives the place there. A
block is one binary value: header, document directory, then for each level its chunks, bitmap and directory. Blocks
hold whole documents in ascending doc_id order and are stored as Parquet rows (part, block, n_docs, n_ids, payload),
so that any store Spark writes to will do.

Texts are encoded by the given tokenizer file. White space always separates its words, so each different part of a text
is encoded once per worker while it stays in a bounded cache; the ids equal those of the whole text (tested).

Defined cases: a null or empty text has the end id alone; null doc_ids come first; rows that repeat an id are written
one after the other, each with its own ids; an empty table gives no blocks; other columns are left out.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderweave.session import scratch

CHUNK_BITS = 8
RANK_STEP = 512
#: A block is closed when it holds this many ids; it can pass it by one document.
BLOCK_IDS = 1 << 20
#: Documents encoded at a time.
ENCODED = 256
#: Words a worker remembers; a longer word is encoded each time.
CACHED_WORDS, CACHED_LENGTH = 1 << 21, 48

MAGIC = b"OWT1"
ONES = np.array([bin(x).count("1") for x in range(256)], np.int64)


#: Texts of white space, printable ASCII without apostrophe and "<", and composed Latin letters: there, runs of letters,
#: single digits and runs of the rest never join into one token.
PLAIN = re.compile("[ \\t\\n\\r!-&(-;=-~À-ÖØ-öø-ÿ]*")
PLAIN_PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^ \\t\\n\\ra-z0-9ß-öø-ÿ]+")
#: Stands before a word that is not plain, among the parts of a text; no plain part begins with it.
ODD = "\0"


@lru_cache(maxsize=2)
def word_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Texts to the little-endian 32-bit ids of the tokenizer file, without special tokens added.

    One encoder, with its cache, serves all tasks of a worker process. Plain texts are cut into parts that go to the
    model of the file, since normalising and splitting them is known; other words, between spaces, take the whole tokenizer.
    `splits_plainly` checks on first use that the file treats plain texts so.
    """
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
    tokenizer = Tokenizer.from_file(path)
    model_only, model_of_bytes = Tokenizer(tokenizer.model), Tokenizer(tokenizer.model)
    model_of_bytes.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
    known: dict[str, bytes] = {}

    def learn(encoder, keys: list[str], skip: int = 0) -> None:
        if keys:
            found = encoder.encode_batch_fast([k[skip:] for k in keys] if skip else keys, add_special_tokens=False)
            known.update((k, array("I", e.ids).tobytes()) for k, e in zip(keys, found))

    def parts_of(text: str) -> list[str]:
        if splits_plainly and PLAIN.fullmatch(text):
            return PLAIN_PARTS.findall(text.lower())
        out: list[str] = []
        for word in text.split(" "):
            if splits_plainly and PLAIN.fullmatch(word):
                out += PLAIN_PARTS.findall(word.lower())
            else:
                out.append(ODD + word)
        return out

    def encode(texts: list[str]) -> list[bytes]:
        cut = [parts_of(text) for text in texts]
        fresh = set().union(*cut).difference(known)
        if len(known) + len(fresh) > CACHED_WORDS:
            known.clear()
            fresh = set().union(*cut)
        learn(model_only, [p for p in fresh if p.isascii() and p[0] != ODD])
        learn(model_of_bytes, [p for p in fresh if not p.isascii() and p[0] != ODD])
        learn(tokenizer, [p for p in fresh if p[0] == ODD], 1)
        out = [b"".join(map(known.__getitem__, parts)) for parts in cut]
        for part in fresh:
            if len(part) > CACHED_LENGTH:
                del known[part]
        return out

    splits_plainly = True
    probe = ["Word, A1b22!?\nx ... UPPER-lower_9  tokenization(s) ##", "Élève,\tstraße ÿ 10.5 "]
    whole = [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(probe, add_special_tokens=False)]
    splits_plainly = encode(probe) == whole
    known.clear()
    return encode


class Level:
    """One chunk level of a block that is being read."""

    def __init__(self, chunks: np.ndarray, bitmap: np.ndarray, ranks: np.ndarray):
        self.chunks, self.bitmap, self.ranks = chunks, bitmap, ranks

    def goes_on(self, at: int) -> bool:
        return bool(self.bitmap[at >> 3] >> (7 - (at & 7)) & 1)

    def rank(self, at: int) -> int:
        """Ones before bit ``at``: one directory entry and less than 64 bytes of bitmap."""
        step = at // RANK_STEP
        whole = self.bitmap[step * RANK_STEP // 8: at >> 3]
        rest = int(self.bitmap[at >> 3]) >> (8 - (at & 7)) if at & 7 else 0
        return int(self.ranks[step]) + int(ONES[whole].sum()) + rest.bit_count()


def encode_block(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """A block of whole documents; ``ids`` are the ids of all of them, one after the other."""
    levels, rest = [], ids.astype(np.uint64)
    while True:
        chunks = (rest & np.uint64(255)).astype(np.uint8)
        more = (rest >> np.uint64(CHUNK_BITS)) > 0
        bitmap = np.packbits(more)
        steps = np.add.reduceat(
            ONES[bitmap], np.arange(0, len(bitmap), RANK_STEP // 8)) if len(bitmap) else np.zeros(0, np.int64)
        ranks = np.r_[0, np.cumsum(steps)].astype("<u8")
        levels.append(struct.pack("<Q", len(chunks)) + chunks.tobytes() + bitmap.tobytes() + ranks.tobytes())
        if not more.any():
            break
        rest = rest[more] >> np.uint64(CHUNK_BITS)
    named = np.array([d is not None for d in doc_ids], np.uint8)
    names = np.array([d or 0 for d in doc_ids], "<i8")
    ends = np.cumsum(np.array(counts, np.int64)).astype("<u8")
    head = MAGIC + struct.pack("<QQB", len(doc_ids), len(ids), len(levels))
    return head + named.tobytes() + names.tobytes() + ends.tobytes() + b"".join(levels)


class Block:
    """Random access to the ids of one block."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a token block")
        self.n_docs, self.n_ids, n_levels = struct.unpack_from("<QQB", payload, 4)
        at = 4 + struct.calcsize("<QQB")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        named, names = take("u1", self.n_docs), take("<i8", self.n_docs)
        self.doc_ids = [int(d) if ok else None for d, ok in zip(names, named)]
        self.ends = take("<u8", self.n_docs).astype(np.int64)
        self.levels = []
        for _ in range(n_levels):
            n = int(take("<u8", 1)[0])
            chunks, bitmap = take("u1", n), take("u1", -(-n // 8))
            self.levels.append(Level(chunks, bitmap, take("<u8", -(-n // RANK_STEP) + 1)))

    def token(self, at: int) -> int:
        """Id number ``at`` of the block, in as many steps as it has chunks."""
        value, shift = 0, 0
        for level in self.levels:
            value |= int(level.chunks[at]) << shift
            if not level.goes_on(at):
                break
            at, shift = level.rank(at), shift + CHUNK_BITS
        return value

    def span(self, start: int, end: int) -> np.ndarray:
        """Ids start .. end-1, by one rank at the start of each level."""
        out = np.zeros(end - start, np.uint64)
        where, shift = np.arange(end - start), 0
        for level in self.levels:
            n = len(where)
            if not n:
                break
            out[where] |= level.chunks[start: start + n].astype(np.uint64) << np.uint64(shift)
            bits = np.unpackbits(level.bitmap[start >> 3: (start + n + 7) >> 3])[start & 7:][:n].astype(bool)
            start, where, shift = level.rank(start) if start < len(level.chunks) else 0, where[bits], shift + CHUNK_BITS
        return out.astype(np.uint32)

    def document(self, n: int) -> np.ndarray:
        return self.span(int(self.ends[n - 1]) if n else 0, int(self.ends[n]))


STORED = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
    T.StructField("n_docs", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("payload", T.BinaryType())])


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, path: str, block_ids: int = BLOCK_IDS) -> None:
    """Encodes all documents, appends the end id to each and writes the blocks below ``path``.

    Parts are ranges of doc_id, so (part, block) ascends with doc_id.
    """
    spark = docs.sparkSession
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(tokenizer_path)
        part, number, names, counts, held, total = None, 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            payload = encode_block(names, counts, np.frombuffer(b"".join(held), "<u4"))
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(names)], pa.int64()),
                pa.array([total], pa.int64()), pa.array([payload], pa.binary())], names=STORED.names)

        for batch in batches:
            for begin in range(0, batch.num_rows, ENCODED):
                parts, doc_ids, texts = (c.to_pylist() for c in batch.slice(begin, ENCODED).columns)
                part = parts[0]
                for doc_id, ids in zip(doc_ids, encode([text or "" for text in texts])):
                    names.append(doc_id)
                    held += [ids, end]
                    counts.append(len(ids) // 4 + 1)
                    total += counts[-1]
                    if total >= block_ids:
                        yield close()
                        number, names, counts, held, total = number + 1, [], [], [], 0
        if names:
            yield close()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.select("doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
        .mapInArrow(run, STORED).write.parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the ids as little-endian 32-bit binary, from the files alone."""
    stored = spark.read.schema(STORED).parquet(path)
    of_part = stored.groupBy(F.col("part").alias("of")).agg(F.sum("n_ids").alias("n"))
    before_part = of_part.select("of", F.coalesce(F.sum("n").over(
        W.orderBy("of").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    before_block = stored.select("part", "block", F.coalesce(F.sum("n_ids").over(
        W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("block_start"))
    starts = (
        before_block.join(before_part, F.col("part") == F.col("of"))
        .select(F.col("part").alias("p"), F.col("block").alias("b"), (F.col("part_start") + F.col("block_start")).alias("at"))
    )
    placed = stored.join(starts, (F.col("part") == F.col("p")) & (F.col("block") == F.col("b"))).select("at", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Block(payload.as_py())
                first = 0
                for begin in range(0, block.n_docs, 256):
                    rows = range(begin, min(begin + 256, block.n_docs))
                    ids = [block.document(n) for n in rows]
                    starts = [at + (int(block.ends[n - 1]) if n else 0) for n in rows]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([block.doc_ids[n] for n in rows], pa.int64()), pa.array(starts, pa.int64()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def store_and_read(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Writes the documents' ids to a new place in the shared folder and reads them back."""
    path = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer_path, end_id, path)
    return read_tokens(docs.sparkSession, path)
