"""Fixtures of the llm tests: documents with awkward rows and clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

CLASHING = ["_row", "_key", "_text", "_doc", "_id", "_hash", "bucket", "fp", "key", "root", "spans", "places", "score", "n_tokens", "a.b"]


def texts(seed: int = 1, n: int = 60) -> list[str]:
    rng = random.Random(seed)
    words = ["the", "of", "Ärger", "été", "'s", "don't", "x²", "漢字", "a" * 30, "12", "...", "token", "MIT", "License"]
    out = ["".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t", ", ", ""]) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return out + ["", " ", "😀", "\x00\x00", "a" * 5000, "ab " * 20_000]


@pytest.fixture(scope="session")
def awkward():
    """(doc_id, text) rows: nulls, empty and long texts, ties, repeated rows."""
    rows = [(i * 3, t) for i, t in enumerate(texts())]
    return rows + rows[:2] + [(500, None), (None, "MIT license here"), (None, None), (502, rows[0][1])]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clash=False):
        full = [(i, t, ["en", "fr", None][k % 3], f"s{k % 4}" if k % 5 else None, len(t or "")) for k, (i, t) in enumerate(rows)]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        for c in CLASHING if clash else []:
            df = df.withColumn(c, F.lit(1))
        return df

    return make


def as_key(value):
    return -(1 << 63) if value is None else value
