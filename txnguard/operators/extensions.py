"""Extensions the reports describe without code (EXT-1, EXT-2, EXT-3, EXT-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import is_fraud, parse_ts


def customer_profiles(df: DataFrame) -> DataFrame:
    """EXT-1: per customer mean and sample std of the amount, and transactions
    per active day."""
    return df.groupBy("customer_id").agg(
        F.avg("amt").alias("mean_amount"),
        F.stddev_samp("amt").alias("std_amount"),
        (F.count(F.lit(1)) / F.countDistinct(F.to_date(parse_ts("post_ts")))).alias("mean_nb_tx_per_day"),
    )


def terminal_risk(df: DataFrame) -> DataFrame:
    """EXT-2: the customer-risk measures keyed by terminal."""
    return (
        df.groupBy("terminal_id")
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            F.sum(is_fraud("fraud")).cast("long").alias("fraudulent_transactions"),
            F.sum("amt").alias("total_amount"),
        )
        .withColumn("fraud_rate", F.col("fraudulent_transactions") / F.col("total_transactions"))
    )


def rolling_customer_stats(df: DataFrame, window_days: int = 7) -> DataFrame:
    """EXT-3: per transaction, the customer's count and mean amount over the
    trailing ``window_days`` (inclusive of the current instant).

    A plain window partitioned by customer would put a customer's whole history
    into one task. Instead time is cut into chunks one window long; each row is
    placed in its own chunk and, as context only, in the next one. A window
    partitioned by (customer, chunk) then sees every row it needs, and no
    group spans more than two window lengths of one customer's activity.
    """
    span = window_days * 86400
    base = df.withColumn("_t", F.unix_timestamp(parse_ts("post_ts"))).where(F.col("_t").isNotNull())
    own = base.withColumn("_chunk", F.floor(F.col("_t") / span)).withColumn("_own", F.lit(True))
    ctx = own.withColumn("_chunk", F.col("_chunk") + 1).withColumn("_own", F.lit(False))
    w = Window.partitionBy("customer_id", "_chunk").orderBy("_t").rangeBetween(-(span - 1), 0)
    return (
        own.unionByName(ctx)
        .withColumn("rolling_count", F.count(F.lit(1)).over(w))
        .withColumn("rolling_mean_amount", F.avg("amt").over(w))
        .where(F.col("_own"))
        .drop("_t", "_chunk", "_own")
    )


def unified_customer_view(batch_risk: DataFrame, predictions: DataFrame) -> DataFrame:
    """EXT-6: batch customer risk joined with aggregates of recent predictions
    (left join: customers without recent predictions keep NULLs)."""
    recent = predictions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("recent_predictions"),
        F.avg("fraud_probability").alias("recent_mean_probability"),
    )
    return batch_risk.join(recent, "customer_id", "left")
