"""Feature preparation and the per-dataset encoders (PR-1, PR-3..12).

The reference encodes one Python dict at a time; here each encoder is a single
projection over the whole DataFrame (map literals, casts, renames), so it runs
inside whole-stage codegen with no Python worker and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    balance_ratio,
    entry_mode_code,
    global_rank,
    is_merchant,
    transaction_id,
    type_code,
)


def prepare_transfers(df: DataFrame) -> DataFrame:
    """PR-1: add amount_to_balance_ratio, rename isFraud to fraud."""
    return df.withColumn("amount_to_balance_ratio", balance_ratio("amount", "oldbalanceOrg")).withColumnRenamed(
        "isFraud", "fraud"
    )


def with_transaction_id(df: DataFrame) -> DataFrame:
    """PR-3: ``nameOrig_step`` id (Q5)."""
    return df.withColumn("transaction_id", transaction_id("nameOrig", "step"))


def cast_transfers(df: DataFrame) -> DataFrame:
    """PR-4: amount to float, fraud to int."""
    return df.withColumns({"amount": F.col("amount").cast("float"), "fraud": F.col("fraud").cast("int")})


CARD_BEHAVIOUR_FLOATS = ["distance_from_home", "distance_from_last_transaction", "ratio_to_median_purchase_price"]
CARD_BEHAVIOUR_INTS = ["fraud", "repeat_retailer", "used_chip", "used_pin_number", "online_order"]


def cast_card_behaviour(df: DataFrame) -> DataFrame:
    """PR-5: three floats and five ints, in the reference's column order."""
    order = ["distance_from_home", "distance_from_last_transaction", "fraud",
             "ratio_to_median_purchase_price", "repeat_retailer", "used_chip",
             "used_pin_number", "online_order"]
    return df.select(
        *[F.col(c).cast("float" if c in CARD_BEHAVIOUR_FLOATS else "int").alias(c) for c in order]
    )


def cast_card_transactions(df: DataFrame) -> DataFrame:
    """PR-6: amt float, fraud int, keep the customer and transaction ids."""
    return df.select(
        F.col("amt").cast("float").alias("amt"),
        F.col("fraud").cast("int").alias("fraud"),
        "customer_id",
        "transaction_id",
    )


def encode_transfers(df: DataFrame, normalize: bool = False) -> DataFrame:
    """PR-7: type code (unknown 0), merchant flag as int, amounts and flags kept.

    ``normalize`` folds ``_`` to ``-`` first, so ``CASH_OUT`` codes like ``CASH-OUT`` (Q9).
    """
    return df.select(
        type_code("type", normalize=normalize).alias("type"),
        "amount",
        "oldbalanceOrg",
        "newbalanceOrig",
        is_merchant("nameDest").alias("isMerchant"),
        "isFlaggedFraud",
        "isFraud",
    )


def encode_card_behaviour(df: DataFrame) -> DataFrame:
    """PR-8: three measures, three int flags, label as isFraud; online_order dropped (Q12)."""
    return df.select(
        "distance_from_home",
        "distance_from_last_transaction",
        "ratio_to_median_purchase_price",
        F.col("repeat_retailer").cast("int").alias("repeat_retailer"),
        F.col("used_chip").cast("int").alias("used_chip"),
        F.col("used_pin_number").cast("int").alias("used_pin_number"),
        F.col("fraud").cast("int").alias("isFraud"),
    )


def encode_card_transactions(df: DataFrame, label: str = "zero") -> DataFrame:
    """PR-9: entry mode code, amt renamed amount; label constant 0 as in the
    reference (``label="zero"``, Q11) or the real fraud label (``label="fraud"``)."""
    lab = F.lit(0) if label == "zero" else F.col("fraud").cast("int")
    return df.select(
        "customer_id",
        "bin",
        F.col("amt").alias("amount"),
        entry_mode_code("entry_mode").alias("entry_mode"),
        lab.alias("isFraud"),
    )


def encode_pca(df: DataFrame) -> DataFrame:
    """PR-10: drop Time, Amount -> amount, Class -> isFraud, keep the rest."""
    rest = [c for c in df.columns if c not in ("Time", "Amount", "Class")]
    return df.select(*rest, F.col("Amount").alias("amount"), F.col("Class").alias("isFraud"))


MAX_CODES = 10_000


def category_codes(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """PR-11: replace ``col`` by the rank of its value among the sorted distinct
    values (0..n-1); NULL gets -1, like pandas ``cat.codes``.

    The codes of up to ``MAX_CODES`` values are read (that many distinct values at
    most) and broadcast, so no row is shuffled on its category. Beyond that the
    code table is computed distributed and joined; the result is the same.
    """
    values = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_CODES + 1).collect()]
    if len(values) <= MAX_CODES:
        rows = [(v, i) for i, v in enumerate(sorted(values, key=lambda v: v.encode() if isinstance(v, str) else v))]
        schema = T.StructType([T.StructField(col, df.schema[col].dataType), T.StructField("_code", T.IntegerType())])
        codes = F.broadcast(df.sparkSession.createDataFrame(rows, schema))
    else:
        codes = global_rank(df, col, "_code")
    return (
        df.join(codes, on=col, how="left")
        .withColumn(out or col, F.coalesce(F.col("_code"), F.lit(-1)))
        .drop("_code")
    )


def drop_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """PR-12: feature selection by dropping columns."""
    return df.drop(*cols)
