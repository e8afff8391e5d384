"""From raw documents to token ids: the operators of `orderweave.llm` as stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. `run` writes what a stage returns to the folder named
by ``spark.checkpoint.dir`` and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderweave.llm import decontaminate, pieces, pii, simhash, toxicity
from orderweave.llm.queries import PIECE_MODEL, SIMHASH_BITS, SIMHASH_WORDS
from orderweave.session import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; all labels may be learned from."""
    return toxicity.remove_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return simhash.keep_first(docs, SIMHASH_WORDS, SIMHASH_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind in brackets."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces and whether decoding gives the text back."""
    return pieces.encode_documents(docs, PIECE_MODEL)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("sentencepiece", encode),
]

#: Scores, fingerprints and pieces are not expressible in SQL; the stages are tested one by one against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
