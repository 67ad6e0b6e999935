"""Corpus pipeline: language ID, near-dedup, suffix dedup, secret redaction, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``. Each
works on all that the stage before kept; ``run`` writes each result as Parquet in
the shared scratch folder and reads it back for the next stage. Tables that a stage
writes on its way are deleted when its result is written.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnguard.llm.common import load, materialise, scratch_scope
from txnguard.llm.language_id import keep_identified, train
from txnguard.llm.packing import best_fit_packing
from txnguard.llm.secret_scan import redact_secrets
from txnguard.llm.simhash import one_of_each_group
from txnguard.llm.suffix_dedup import remove_repeats


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects rows whose language can't be told."""
    return keep_identified(docs, train(docs, F.lit(True)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return one_of_each_group(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out strings of 50 bytes that an earlier document holds."""
    return _counted(remove_repeats(docs, length=50))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the values of secrets that aren't widely copied examples."""
    return _counted(redact_secrets(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 2048 tokens."""
    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"), tokens=2048)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("suffix_dedup", substring_dedup),
    ("secret_scan", secrets),
    ("best_fit_packing", pack),
]

# Fingerprints, tokenizers and a trained classifier: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch_scope(spark):  # what a stage writes on its way goes with it
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
