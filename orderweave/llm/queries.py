"""One query for each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderweave.llm import (
    crosstok, decontaminate, hnsw, licenses, phrases, pieces, pii, repeats, sharding, simhash, tokenstore, topk,
    toxicity)

Query = Callable[[SparkSession, str], DataFrame]

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
SHARDS = 16
SIMHASH_WORDS, SIMHASH_BITS = 4, 4
REPEAT_BYTES = 400


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    learnable = labels.where(~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score_documents(docs, learnable)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids as a digest: their number, a checksum of their text form, and whether decoding gives the text back."""
    encoded = pieces.encode_documents(_table(spark, sf_dir, "documents"), PIECE_MODEL)
    return encoded.select(
        "doc_id", "n_pieces", F.crc32(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary")).alias("ids_crc32"),
        "round_trip")


def pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(_table(spark, sf_dir, "documents"))


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(_table(spark, sf_dir, "documents"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(_table(spark, sf_dir, "documents"))


def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_classes(_table(spark, sf_dir, "documents"), SIMHASH_WORDS, SIMHASH_BITS)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.embedding_classes(_table(spark, sf_dir, "embeddings"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = tokenstore.store_and_read(_table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_ID)
    return stored.select("doc_id", "start", "n_tokens", "ids_crc32")


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digest(_table(spark, sf_dir, "documents"), REPEAT_BYTES, keep="none")


def cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstok.align_documents(_table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_MODEL)


def collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(_table(spark, sf_dir, "documents"))


def topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Query] = {
    "op1_toxicity": toxicity_scores,
    "op2_sentencepiece": sentencepiece,
    "op3_pii": pii_spans,
    "op4_sharding": shards,
    "op5_license_scan": license_scan,
    "op6_simhash_dedup": simhash_dedup,
    "op7_embedding_dedup": embedding_dedup,
    "op8_decontamination": decontamination,
    "op9_token_store": token_store,
    "op10_suffix_dedup": suffix_dedup,
    "op11_cross_tokenizer": cross_tokenizer,
    "op12_collocations": collocations,
    "op13_topk_search": topk_search,
}

ORACLE: dict[str, str] = {
    "op8_decontamination": """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), x -> x <> '') AS w
  FROM documents
), v AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), x -> x <> '') AS w
  FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), i -> array_to_string(w[i:i + 4], ' '))) AS s FROM w
), bs AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), i -> array_to_string(w[i:i + 4], ' '))) AS s FROM v
), n AS (
  SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id
), c AS (
  SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM c JOIN n USING (item_id) WHERE n_shared >= ceil(n_item * 0.8 - 1e-9)""",
    "op12_collocations": """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), p AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), g AS (
  SELECT lang, m, g, count(*) AS a
  FROM (SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') for i in range(1, len(w) - m + 2)]) AS g
        FROM w, range(1, 6) AS sizes(m))
  GROUP BY lang, m, g
), n AS (
  SELECT lang, sum(a) AS n FROM g WHERE m = 1 GROUP BY lang
), often AS (
  SELECT * FROM g WHERE a >= 100
), c AS (
  SELECT lang, m, g, string_split(g, ' ') AS w, a FROM often WHERE m > 1
), around AS (
  SELECT lang, g, max(a) AS around
  FROM (SELECT lang, unnest([array_to_string(w[1:m - 1], ' '), array_to_string(w[2:], ' ')]) AS g, a FROM c WHERE m > 2)
  GROUP BY lang, g
), kept AS (
  SELECT c.* FROM c LEFT JOIN around USING (lang, g) WHERE around IS NULL OR 100 * around < 100 * c.a
), parts AS (
  SELECT lang, g, a, k, array_to_string(w[1:k], ' ') AS lg, array_to_string(w[k + 1:], ' ') AS rg
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)
), cuts AS (
  SELECT p.lang, p.g, p.a, n.n, k, l.a AS l, r.a AS r, CAST((1000::HUGEINT * p.a * n.n) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM parts p JOIN n ON n.lang = p.lang
  JOIN often l ON l.lang = p.lang AND l.g = p.lg JOIN often r ON r.lang = p.lang AND r.g = p.rg
), least AS (
  SELECT lang, g AS phrase, a, n, min(struct_pack(score := score, k := k, l := l, r := r)) AS cut
  FROM cuts GROUP BY lang, g, a, n
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, encode(phrase)) AS rank FROM least
)
SELECT lang, rank, phrase, a, cut.l AS l, cut.r AS r, CAST(n AS BIGINT) AS n, cut.score AS score
FROM ranked WHERE rank <= 2000""",
    "op13_topk_search": """
WITH w AS (
  SELECT row_number() OVER () AS row, vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), p AS (
  SELECT q.row AS query, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM w q JOIN w c ON q.row <> c.row WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
