"""Hand-made documents: nulls, empty and long texts, repeated rows, clashing column names."""

from __future__ import annotations

import random

import duckdb

TABLES = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, component long, spans string"
EMPTY_DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def stored(table: str, columns: str) -> list[tuple]:
    return duckdb.sql(f"SELECT {columns} FROM '{TABLES}/{table}.parquet' ORDER BY 1").fetchall()


def passage(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rng.randint(2, 9)))
                    for _ in range(words))


def texts() -> list[tuple[int | None, str | None]]:
    shared = passage(1, 120)
    near = passage(2, 200)
    rows: list[tuple[int | None, str | None]] = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "a b"), (None, "no id here"), (None, None),
        (6, near), (7, near), (7, near), (8, near + " tail"), (9, near.replace(near.split()[50], "changed", 1)),
        (10, passage(3, 40) + " " + shared + " " + passage(4, 30)), (11, shared + " " + passage(5, 20)),
        (12, passage(6, 5) + " " + shared), (13, shared[:399]), (14, "x" * 3000), (15, "ab" * 700 + passage(7, 10)),
        (16, passage(8, 12000)), (-5, "negative id"), (17, "Ω\U0001F600 a@b.co \U0001F600 +1 (017) 555-7713."),
        (18, shared[:250] + passage(9, 30)), (19, passage(9, 30) + shared[-420:] + " end"),
    ]
    return rows


def frame(spark, rows):
    """With other columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), 99, 98, "x") for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
