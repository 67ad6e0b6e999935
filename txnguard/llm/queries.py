"""The operators as registered queries: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnguard.llm import oracle_sql
from txnguard.llm.common import load
from txnguard.llm.hard_negatives import hard_negatives
from txnguard.llm.html_extract import extract_text
from txnguard.llm.language_id import language_id
from txnguard.llm.license_scan import license_scan
from txnguard.llm.lz_fingerprint import lz_fingerprints
from txnguard.llm.merkle_manifest import merkle_manifest, without_newlines
from txnguard.llm.packing import best_fit_packing
from txnguard.llm.pivot_topk import pivot_top_k
from txnguard.llm.secret_scan import secret_scan
from txnguard.llm.simhash import simhash_components
from txnguard.llm.suffix_dedup import suffix_dedup
from txnguard.llm.tiktoken_codec import tiktoken_digests
from txnguard.llm.token_counts import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark, sf_dir):
    return secret_scan(load(spark, sf_dir, "documents"))


ORACLE["op1_secret_scan"] = oracle_sql.secret_scan()


@query
def op2_token_counts(spark, sf_dir):
    return token_counts(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query
def op3_best_fit_packing(spark, sf_dir):
    return best_fit_packing(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), tokens=2048)


@query
def op4_lz_fingerprint(spark, sf_dir):
    return lz_fingerprints(load(spark, sf_dir, "documents"))


@query
def op5_simhash(spark, sf_dir):
    return simhash_components(load(spark, sf_dir, "documents"), words=3, distance=2)


@query
def op6_language_id(spark, sf_dir):
    return language_id(load(spark, sf_dir, "documents"))


@query
def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup(load(spark, sf_dir, "documents"), length=50)


ORACLE["op7_suffix_dedup"] = oracle_sql.suffix_dedup()


@query
def op8_pivot_top_k(spark, sf_dir):
    return pivot_top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


ORACLE["op8_pivot_top_k"] = oracle_sql.pivot_top_k()


@query
def op9_tiktoken(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return tiktoken_digests(load(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op10_license_scan(spark, sf_dir):
    return license_scan(load(spark, sf_dir, "documents"))


@query
def op11_html_extract(spark, sf_dir):
    return extract_text(load(spark, sf_dir, "pages"))


@query
def op12_merkle_manifest(spark, sf_dir):
    return merkle_manifest(load(spark, sf_dir, "documents"), tampered=without_newlines())


ORACLE["op12_merkle_manifest"] = oracle_sql.merkle_manifest()


@query
def op13_hard_negatives(spark, sf_dir):
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, relabelled, positives=5, negatives=10, window=(30, 90), scale=256)


ORACLE["op13_hard_negatives"] = oracle_sql.hard_negatives()
