"""Driver tables -> reference-shaped datasets.

The test tables are TPC-H-like; these views give them the shape of the four
fraud datasets (see FIXTURES.md section 4). They are plain projections and one
equi-join each, so Catalyst prunes columns down to the Parquet scan and the
join strategy is left to the optimizer (AQE turns it into a broadcast join only
when the runtime size is under the threshold).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Arrival clock of the replayed streams: record ``key`` arrives ``key`` minutes
# after 2024-01-01 00:00:00 (wall clock, no time zone), one record per key and minute.
ARRIVAL_START = "2024-01-01 00:00:00"


def _arrival_from_key(key: Column) -> list[Column]:
    """Arrival tags derived from a technical key: year, month, day, hour, minute.

    hour = floor(key / 60) % 24 and minute = key % 60 (FIXTURES.md); the date
    continues the same clock, so the bounded join (JOIN-2) has real overlaps.
    """
    # TIMESTAMP_NTZ arithmetic: the tags do not depend on the session time zone.
    ts = F.timestamp_add("MINUTE", key, F.to_timestamp_ntz(F.lit(ARRIVAL_START)))
    return _date_tags(ts) + [
        (F.floor(key / 60.0) % 24).cast("int").cast("string").alias("hour"),
        (key % 60).cast("int").cast("string").alias("minute"),
    ]


def _date_tags(ts: Column) -> list[Column]:
    """"yyyy", "MM", "dd" strings from integer date parts (cheaper per row
    than a pattern formatter)."""
    return [
        F.lpad(F.year(ts).cast("string"), 4, "0").alias("year"),
        F.lpad(F.month(ts).cast("string"), 2, "0").alias("month"),
        F.lpad(F.dayofmonth(ts).cast("string"), 2, "0").alias("day"),
    ]


def transfers(spark: SparkSession, sf_dir: str, tags: bool = False) -> DataFrame:
    """Dataset 1 (payment transfers) from orders x customer."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    amount = F.col("o_totalprice") * F.col("o_totalprice") / 400000
    cols = [
        ((F.col("o_orderkey") % 744).cast("int") + 1).alias("step"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "CASH-IN")
        .when(F.col("o_orderpriority") == "2-HIGH", "CASH_OUT")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "DEBIT")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "PAYMENT")
        .otherwise("TRANSFER")
        .alias("type"),
        amount.alias("amount"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("nameOrig"),
        F.col("c_acctbal").alias("oldbalanceOrg"),
        F.greatest(F.col("c_acctbal") - amount, F.lit(0.0)).alias("newbalanceOrig"),
        F.concat(
            F.when(F.col("o_orderkey") % 3 == 0, "M").otherwise("C"),
            F.col("o_orderkey").cast("string"),
        ).alias("nameDest"),
        F.lit(0.0).alias("oldbalanceDest"),
        F.lit(0.0).alias("newbalanceDest"),
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000), 1)
        .otherwise(0)
        .alias("isFraud"),
        F.when((F.col("o_orderpriority") == "5-LOW") & (amount > 200000), 1)
        .otherwise(0)
        .alias("isFlaggedFraud"),
        F.col("o_orderkey"),
    ]
    if tags:
        cols += _arrival_from_key(F.col("o_orderkey"))
    return o.join(c, o.o_custkey == c.c_custkey).select(*cols)


def card_behaviour(spark: SparkSession, sf_dir: str, tags: bool = False) -> DataFrame:
    """Dataset 2 (card behaviour) from lineitem x part."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    cols = [
        F.col("l_quantity").alias("distance_from_home"),
        (F.col("l_tax") * 100).alias("distance_from_last_transaction"),
        (F.col("l_extendedprice") / (F.col("p_retailprice") * F.col("l_quantity"))).alias(
            "ratio_to_median_purchase_price"
        ),
        F.when(F.col("l_linenumber") > 1, 1).otherwise(0).alias("repeat_retailer"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("used_chip"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("used_pin_number"),
        F.when(F.col("l_returnflag") == "N", 1).otherwise(0).alias("online_order"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40), 1)
        .otherwise(0)
        .alias("fraud"),
        F.col("l_orderkey"),
    ]
    if tags:
        cols += [F.col("l_linenumber")]
        cols += _arrival_from_key(F.col("l_orderkey"))
    return li.join(p, li.l_partkey == p.p_partkey).select(*cols)


POST_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def card_transactions(spark: SparkSession, sf_dir: str, tags: bool = False) -> DataFrame:
    """Dataset 3 (card transactions) from events."""
    e = table(spark, sf_dir, "events")
    cols = [
        F.concat(F.lit("X"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.date_format("ts", POST_TS_FORMAT).alias("post_ts"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("customer_id"),
        (F.lit(400000) + F.col("user_id")).cast("int").alias("bin"),
        F.concat(F.lit("T"), (F.col("event_id") % 50).cast("string")).alias("terminal_id"),
        F.col("value").alias("amt"),
        F.when(F.col("event_type") == "view", "Contactless")
        .when(F.col("event_type") == "click", "Chip")
        .when(F.col("event_type") == "purchase", "Swipe")
        .otherwise(F.col("event_type"))
        .alias("entry_mode"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("fraud"),
        F.when(F.col("event_type") == "error", 1 + F.col("event_id") % 2)
        .otherwise(0)
        .cast("int")
        .alias("fraud_scenario"),
    ]
    if tags:
        cols += [F.col("event_id")]
        cols += _date_tags(F.col("ts")) + [
            F.hour("ts").cast("string").alias("hour"),
            F.minute("ts").cast("string").alias("minute"),
        ]
    return e.select(*cols)


def pca_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset 4 (PCA card): V1..V28 from the first 28 embedding entries."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").cast("double").alias("Time"),
        *[F.get("embedding", i).cast("double").alias(f"V{i + 1}") for i in range(28)],
        (F.col("vec_id") * 1.5).alias("Amount"),
        F.when(F.col("label") == 0, 1).otherwise(0).alias("Class"),
    )
