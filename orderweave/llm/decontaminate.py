"""Benchmark items found inside documents by size-partitioned MinHash containment search.

An item is found in a document that holds at least ``share`` of the item's different five-word shingles. An item with m
shingles may miss at most ``m - ceil(share * m)`` of them, so of any one more than that at least one is in the
document. The items are partitioned by size; the MinHash sketch of an item is the smallest hashes of its shingles, as
many as the largest item of its partition needs. A document that holds the item therefore always holds an entry of the
sketch: the search loses nothing, however long the document is, which signatures of fixed length could not promise.
Candidates are then verified by exact containment of the shingle texts. Everything is built-in SQL functions.

Words are runs of letters and digits in lower case.

Defined cases: null or empty texts and items of fewer than five words are never found; rows that repeat a doc_id (or item_id)
count as one document (item) with the shingles of all of them, null ids among them; an empty table gives no rows; other
columns are ignored. The sketch is broadcast only if its counted rows are few; otherwise both sides are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderweave.session import materialize, small_side

WORDS = 5
SHARE = 0.8


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _starts(words: str, width: int) -> Column:
    """Start of every shingle; none if there are too few words."""
    n = F.size(words) - width + 1
    return F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<int>"))


def shingle_texts(words: str, width: int = WORDS) -> Column:
    return F.array_distinct(F.transform(
        _starts(words, width), lambda i: F.concat_ws(" ", F.slice(F.col(words), i, width))))


def hashed_shingles(df: DataFrame, text: str, width: int = WORDS) -> DataFrame:
    """Adds ``__hash``: the different shingle hashes of each row, as an array."""
    return (
        df.withColumn("__w", words_of(F.col(text)))
        .withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w)))
        .withColumn("__hash", F.array_distinct(F.transform(_starts("__h", width), lambda i: F.xxhash64(
            *[F.element_at(F.col("__h"), i + k) for k in range(width)]))))
    )


def item_shingles(items: DataFrame, width: int = WORDS, share: float = SHARE) -> DataFrame:
    """item_id, shingle, hash, n (different shingles of the item), need (how many must be shared), in_sketch."""
    one = (
        items.select("item_id", words_of(F.col("text")).alias("__w"))
        .select("item_id", F.explode_outer(shingle_texts("__w", width)).alias("shingle"))
        .where(F.col("shingle").isNotNull()).distinct()
        .withColumn("hash", F.xxhash64(*[
            F.xxhash64(F.element_at(F.split("shingle", " "), k + 1)) for k in range(width)]))
    )
    of_item = W.partitionBy("item_id")
    # sizes of one partition lie between a power of two and the next
    upper = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n"))) + 1) - 1
    sketch = F.floor(upper * (1 - share) + 1e-9) + 1
    return (
        one.withColumn("n", F.count("*").over(of_item))
        .withColumn("need", F.ceil(F.col("n") * F.lit(share) - 1e-9))
        .withColumn("in_sketch", F.row_number().over(of_item.orderBy("hash", "shingle")) <= sketch)
    )


def find_items(docs: DataFrame, items: DataFrame, width: int = WORDS, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, n_shared, n_item and containment of every item found in a document."""
    known = materialize(item_shingles(items, width, share), "item-shingles")
    sketch = small_side(known.where("in_sketch").select("hash", "item_id"), "item-sketch")
    hashed = hashed_shingles(docs.select("doc_id", "text"), "text", width).select(
        "doc_id", F.explode_outer("__hash").alias("doc_hash"))
    candidates = materialize(
        hashed.join(sketch, F.col("doc_hash") == F.col("hash")).select("doc_id", "item_id").distinct(), "candidates")
    wanted = materialize(candidates.select(F.col("doc_id").alias("of")).distinct(), "candidate-documents")
    texts = (
        docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("of")))
        .select("doc_id", words_of(F.col("text")).alias("__w"))
        .select("doc_id", F.explode_outer(shingle_texts("__w", width)).alias("doc_shingle"))
    )
    pairs = small_side(known.select("item_id", "shingle", "n", "need"), "item-texts")
    shared = (
        texts.join(pairs, F.col("doc_shingle") == F.col("shingle"))
        .select("doc_id", "item_id", "shingle", "n", "need").distinct()
        .groupBy("doc_id", "item_id").agg(
            F.count("*").alias("n_shared"), F.max("n").alias("n_item"), F.max("need").alias("need"))
        .where(F.col("n_shared") >= F.col("need"))
    )
    return (
        shared.join(candidates.select(F.col("doc_id").alias("cd"), F.col("item_id").alias("ci")),
                    F.col("doc_id").eqNullSafe(F.col("cd")) & F.col("item_id").eqNullSafe(F.col("ci")), "left_semi")
        .select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, width: int = WORDS, share: float = SHARE) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    found = materialize(
        find_items(docs, items, width, share).select(F.col("doc_id").alias("__found")).distinct(), "contaminated")
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("__found")), "left_anti")
