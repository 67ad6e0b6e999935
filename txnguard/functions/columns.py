"""Column expressions shared by the operators. All are built-in Spark
expressions, so they stay inside whole-stage codegen (no Python UDF)."""

from __future__ import annotations

from itertools import chain

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import (
    AMOUNT_BUCKET_TOP,
    AMOUNT_BUCKETS,
    ENTRY_MODE_CODES,
    MERCHANT_PREFIX,
    TRANSACTION_TYPE_CODES,
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_fraud(label="isFraud") -> Column:
    """1 when the label equals 1; NULL and every other value count as 0 (Q3)."""
    return F.when(_c(label) == 1, 1).otherwise(0)


def amount_bucket(amount="amount") -> Column:
    """Bucket label; bounds inclusive, NULL falls through to the top bucket (Q2)."""
    a = _c(amount)
    expr = None
    for bound, label in AMOUNT_BUCKETS:
        expr = F.when(a <= bound, label) if expr is None else expr.when(a <= bound, label)
    return expr.otherwise(AMOUNT_BUCKET_TOP)


def balance_ratio(amount="amount", balance="oldbalanceOrg") -> Column:
    """amount / balance when balance > 0, else 0 (Q4)."""
    b = _c(balance)
    return F.when(b > 0, _c(amount) / b).otherwise(F.lit(0.0))


def transaction_id(name="nameOrig", step="step") -> Column:
    """``nameOrig_step``; NULL step gives NULL; NULL nameOrig a per-row uuid (Q5)."""
    n = _c(name)
    return F.when(
        n.isNotNull(), F.concat(n, F.lit("_"), _c(step).cast("string"))
    ).otherwise(F.expr("uuid()"))


def code_lookup(col, codes: dict, default: int = 0, normalize: bool = False) -> Column:
    """Map a string to a fixed integer code, unknown and NULL to ``default``."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in codes.items()))
    key = _c(col)
    if normalize:
        key = F.regexp_replace(key, "_", "-")
    return F.coalesce(F.try_element_at(m, key), F.lit(default)).cast("int")


def type_code(col="type", normalize: bool = False) -> Column:
    return code_lookup(col, TRANSACTION_TYPE_CODES, normalize=normalize)


def entry_mode_code(col="entry_mode") -> Column:
    return code_lookup(col, ENTRY_MODE_CODES)


def is_merchant(col="nameDest") -> Column:
    return _c(col).startswith(MERCHANT_PREFIX).cast("int")


def parse_ts(col) -> Column:
    """A string timestamp read the way the reference's implicit cast reads it
    (``2023-02-01 00:00:30``, ``2024-12-07T12:00:00Z``, fractions, offsets,
    date only), in the session time zone; unparsable text gives NULL instead
    of failing the job under ANSI (Q16)."""
    return _c(col).try_cast("timestamp")


def hour_of(col) -> Column:
    return F.hour(parse_ts(col))


def prob_class1(col="probability") -> Column:
    """Probability of class 1 from an ML vector, JVM-side, dense or sparse."""
    return F.get(vector_to_array(_c(col)), 1)


def vec_item(col, i: int) -> Column:
    return F.get(vector_to_array(_c(col)), i)


def hash_unit(key_cols, seed: int) -> Column:
    """Deterministic uniform value in [0, 1) per row, independent of partitioning:
    the first 32 bits of md5(key | key | ... | seed), which any SQL engine can
    compute too. A NULL key counts as empty."""
    text = F.concat_ws("|", *[F.coalesce(_c(k).cast("string"), F.lit("")) for k in key_cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
