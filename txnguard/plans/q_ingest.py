"""Ingest, encoders, file sources and sinks: SRC-2..5, SRC-7, SNK-4, SNK-5,
V-1..3, PR-1, PR-3..12."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from .. import adapters
from ..operators import encode, ingest
from ..sinks.files import land, write_arff, write_csv
from ..session import scratch_path
from ..sources.files import read_arff, read_csv, read_landed, read_partitioned, register_partitioned_table
from ..specs import CARD_BEHAVIOUR, TRANSFERS
from .registry import register

TRANSFER_COLS = [n for n, _ in TRANSFERS.columns]
TAGS = ["year", "month", "day", "hour", "minute"]


def transfer_records(spark, sf):
    """Transfers as stream records (JSON text). Accounts with a balance at or
    below zero send their amount as currency text ("$12.5"), which the typed
    decode turns into NULL: those records must end in quarantine."""
    t = adapters.transfers(spark, sf, tags=True)
    rec = t.select(
        F.to_json(F.struct(*TAGS, *TRANSFER_COLS)).alias("value"), F.col("oldbalanceOrg").alias("_bal")
    )
    return rec.select(
        F.when(
            F.col("_bal") <= 0,
            F.regexp_replace("value", r'"amount":([-0-9.Ee+]+)', '"amount":"\\$$1"'),
        )
        .otherwise(F.col("value"))
        .alias("value")
    )


def _real(c):
    return f"CAST({c} AS REAL) AS {c}"


DECODED_SQL = f"""
SELECT year, month, day, hour, minute, step, type,
  CASE WHEN oldbalanceOrg <= 0 THEN NULL ELSE CAST(amount AS REAL) END AS amount,
  nameOrig, {_real('oldbalanceOrg')}, {_real('newbalanceOrig')}, nameDest,
  {_real('oldbalanceDest')}, {_real('newbalanceDest')}, isFraud, isFlaggedFraud
FROM transfers
"""


@register("src2_decode_records", DECODED_SQL)
def src2(spark, sf):
    """JSON stream records decoded with the fixed schema (PERMISSIVE, Q6)."""
    return ingest.decode(transfer_records(spark, sf), TRANSFERS, keep_raw=False)


@register("v1_validate_valid", f"SELECT * FROM ({DECODED_SQL}) d WHERE amount IS NOT NULL")
def v1_valid(spark, sf):
    good, _ = ingest.validate(ingest.decode(transfer_records(spark, sf), TRANSFERS, keep_raw=False), TRANSFERS)
    return good


@register(
    "v1_validate_quarantine",
    "SELECT nameOrig, step, 'missing:amount' AS reason FROM transfers WHERE oldbalanceOrg <= 0",
)
def v1_bad(spark, sf):
    _, bad = ingest.validate(ingest.decode(transfer_records(spark, sf), TRANSFERS), TRANSFERS)
    return bad.select("nameOrig", "step", "reason")


@register(
    "v2_date_tags",
    """SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
  strftime(ts, '%d') AS day, CAST(hour(ts) AS VARCHAR) AS hour, CAST(minute(ts) AS VARCHAR) AS minute
FROM events""",
)
def v2(spark, sf):
    return ingest.tag(adapters.table(spark, sf, "events"), "ts").select("event_id", *TAGS)


CB_COLS = [n for n, _ in CARD_BEHAVIOUR.columns]
CB_FLOATS = {"distance_from_home", "distance_from_last_transaction", "ratio_to_median_purchase_price"}
CB_TYPED_SQL = ", ".join(
    f"CAST({c} AS REAL) AS {c}" if c in CB_FLOATS else f"CAST({c} AS INT) AS {c}" for c in CB_COLS
)


@register("v3_conform", f"SELECT {CB_TYPED_SQL} FROM card_behaviour")
def v3(spark, sf):
    """All-text records (as a CSV or form post delivers them) conformed to the schema."""
    text = adapters.card_behaviour(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in CB_COLS])
    return ingest.conform(text, CARD_BEHAVIOUR, keep_extra=False)


@register("src3_catalog_table", "SELECT * EXCLUDE (year, month, day, hour, minute) FROM transfers")
def src3(spark, sf):
    from ..sources.files import read_table

    adapters.transfers(spark, sf).createOrReplaceTempView("dataset1")
    return read_table(spark, "dataset1")


def _landed_transfers(spark, sf):
    path = scratch_path(spark, "landing-dataset1")
    t = adapters.transfers(spark, sf, tags=True).select(*TRANSFER_COLS, "year", "month", "day")
    land(ingest.conform(t, TRANSFERS), path)
    return path


@register(
    "src4_partitioned_scan",
    """SELECT year, month, count(*) AS n, CAST(sum(isFraud) AS BIGINT) AS frauds,
  sum(CAST(amount AS REAL)) AS amount FROM transfers GROUP BY year, month""",
)
def src4(spark, sf):
    """Land transfers by date, then scan with partition discovery."""
    df = read_partitioned(spark, _landed_transfers(spark, sf), TRANSFERS)
    return df.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("isFraud").cast("long").alias("frauds"),
        F.sum(F.col("amount").cast("double")).alias("amount"),
    )


@register(
    "src4_partition_pruned",
    """SELECT year, month, day, count(*) AS n FROM transfers
WHERE year || '-' || month || '-' || day BETWEEN '2024-01-03' AND '2024-01-05' GROUP BY ALL""",
)
def src4_pruned(spark, sf):
    """Date-range read: only the directories of 3-5 January are opened."""
    df = read_partitioned(spark, _landed_transfers(spark, sf), TRANSFERS, "2024-01-03", "2024-01-05")
    return df.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


@register(
    "src4_catalog_partitioned_table",
    "SELECT year, count(*) AS n FROM transfers GROUP BY year",
)
def src4_catalog(spark, sf):
    """Catalog form: an external partitioned table, its partitions added as landed."""
    import uuid

    t = register_partitioned_table(spark, f"dataset1_landed_{uuid.uuid4().hex[:12]}", _landed_transfers(spark, sf), TRANSFERS)
    return t.groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@register(
    "snk5_landing_with_quarantine",
    """SELECT CASE WHEN oldbalanceOrg <= 0 THEN 'quarantine' ELSE 'valid' END AS quality,
  year, count(*) AS n FROM transfers GROUP BY ALL""",
)
def snk5(spark, sf):
    """Decode, mark, and land valid and quarantined records in one write."""
    spec = TRANSFERS
    dec = ingest.decode(transfer_records(spark, sf), spec)
    path = scratch_path(spark, "landing-marked")
    land(ingest.mark(dec, spec), path, by_quality=True)
    landed = read_landed(spark, path, spec)
    return landed.groupBy("quality", "year").agg(F.count(F.lit(1)).alias("n"))


@register(
    "src5_csv_scan",
    f"""SELECT step, type, {_real('amount')}, nameOrig, {_real('oldbalanceOrg')},
  {_real('newbalanceOrig')}, nameDest, {_real('oldbalanceDest')}, {_real('newbalanceDest')},
  isFraud, isFlaggedFraud FROM transfers""",
)
def src5(spark, sf):
    """CSV with header written distributed, read back with the typed schema."""
    path = scratch_path(spark, "csv-dataset1")
    write_csv(adapters.transfers(spark, sf).select(*TRANSFER_COLS), path)
    return read_csv(spark, path, TRANSFERS)


CT_DDL = (
    "transaction_id string, post_ts string, customer_id string, bin int, terminal_id string, "
    "amt double, entry_mode string, fraud int, fraud_scenario int"
)


@register(
    "snk4_csv_write",
    "SELECT transaction_id, post_ts, customer_id, bin, terminal_id, amt, entry_mode, fraud, "
    "fraud_scenario FROM card_transactions",
)
def snk4(spark, sf):
    path = scratch_path(spark, "csv-dataset3")
    write_csv(adapters.card_transactions(spark, sf), path)
    return spark.read.schema(CT_DDL).option("header", True).csv(path)


@register(
    "src7_arff_scan",
    "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in CB_COLS) + " FROM card_behaviour",
)
def src7(spark, sf):
    path = scratch_path(spark, "arff-dataset2")
    write_arff(adapters.card_behaviour(spark, sf).select(*CB_COLS), path, "card_behaviour")
    return read_arff(spark, os.path.join(path, "*"))


# ---- feature preparation and encoders -------------------------------------

RATIO_SQL = "CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE 0.0 END"


@register(
    "pr1_balance_ratio",
    f"SELECT o_orderkey, amount, oldbalanceOrg, {RATIO_SQL} AS amount_to_balance_ratio, isFraud AS fraud FROM transfers",
)
def pr1(spark, sf):
    return encode.prepare_transfers(adapters.transfers(spark, sf)).select(
        "o_orderkey", "amount", "oldbalanceOrg", "amount_to_balance_ratio", "fraud"
    )


@register(
    "pr3_transaction_id",
    "SELECT o_orderkey, nameOrig || '_' || CAST(step AS VARCHAR) AS transaction_id FROM transfers",
)
def pr3(spark, sf):
    return encode.with_transaction_id(adapters.transfers(spark, sf)).select("o_orderkey", "transaction_id")


@register(
    "pr4_cast_transfers",
    "SELECT o_orderkey, CAST(amount AS REAL) AS amount, CAST(isFraud AS INT) AS fraud FROM transfers",
)
def pr4(spark, sf):
    df = encode.cast_transfers(encode.prepare_transfers(adapters.transfers(spark, sf)))
    return df.select("o_orderkey", "amount", "fraud")


@register("pr5_cast_card_behaviour", f"SELECT {CB_TYPED_SQL} FROM card_behaviour")
def pr5(spark, sf):
    return encode.cast_card_behaviour(adapters.card_behaviour(spark, sf))


@register(
    "pr6_cast_card_transactions",
    "SELECT CAST(amt AS REAL) AS amt, CAST(fraud AS INT) AS fraud, customer_id, transaction_id FROM card_transactions",
)
def pr6(spark, sf):
    return encode.cast_card_transactions(adapters.card_transactions(spark, sf))


TYPE_CODE_SQL = """CASE {c} WHEN 'CASH-IN' THEN 1 WHEN 'CASH-OUT' THEN 2 WHEN 'DEBIT' THEN 3
  WHEN 'PAYMENT' THEN 4 WHEN 'TRANSFER' THEN 5 ELSE 0 END"""
PR7_SQL = """SELECT {code} AS type, amount, oldbalanceOrg, newbalanceOrig,
  CASE WHEN starts_with(nameDest, 'M') THEN 1 ELSE 0 END AS isMerchant, isFlaggedFraud, isFraud
FROM transfers"""


@register("pr7_encode_transfers", PR7_SQL.format(code=TYPE_CODE_SQL.format(c="type")))
def pr7(spark, sf):
    return encode.encode_transfers(adapters.transfers(spark, sf))


@register(
    "pr7_encode_transfers_normalized",
    PR7_SQL.format(code=TYPE_CODE_SQL.format(c="replace(type, '_', '-')")),
)
def pr7n(spark, sf):
    return encode.encode_transfers(adapters.transfers(spark, sf), normalize=True)


@register(
    "pr8_encode_card_behaviour",
    """SELECT distance_from_home, distance_from_last_transaction, ratio_to_median_purchase_price,
  repeat_retailer, used_chip, used_pin_number, fraud AS isFraud FROM card_behaviour""",
)
def pr8(spark, sf):
    return encode.encode_card_behaviour(adapters.card_behaviour(spark, sf))


ENTRY_SQL = "CASE entry_mode WHEN 'Contactless' THEN 1 WHEN 'Chip' THEN 2 WHEN 'Swipe' THEN 3 ELSE 0 END"


@register(
    "pr9_encode_card_transactions",
    f"SELECT customer_id, bin, amt AS amount, {ENTRY_SQL} AS entry_mode, 0 AS isFraud FROM card_transactions",
)
def pr9(spark, sf):
    return encode.encode_card_transactions(adapters.card_transactions(spark, sf))


@register(
    "pr9_encode_card_transactions_labelled",
    f"SELECT customer_id, bin, amt AS amount, {ENTRY_SQL} AS entry_mode, fraud AS isFraud FROM card_transactions",
)
def pr9l(spark, sf):
    return encode.encode_card_transactions(adapters.card_transactions(spark, sf), label="fraud")


@register(
    "pr10_encode_pca",
    "SELECT " + ", ".join(f"V{i}" for i in range(1, 29)) + ", Amount AS amount, Class AS isFraud FROM pca_card",
)
def pr10(spark, sf):
    return encode.encode_pca(adapters.pca_card(spark, sf))


@register(
    "pr11_category_codes",
    """SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY type) - 1 AS INT) AS type FROM transfers""",
)
def pr11(spark, sf):
    return encode.category_codes(adapters.transfers(spark, sf), "type").select("o_orderkey", "type")


@register(
    "pr11_category_codes_entry_mode",
    "SELECT transaction_id, CAST(dense_rank() OVER (ORDER BY entry_mode) - 1 AS INT) AS entry_mode FROM card_transactions",
)
def pr11b(spark, sf):
    df = encode.category_codes(adapters.card_transactions(spark, sf), "entry_mode")
    return df.select("transaction_id", "entry_mode")


@register(
    "pr12_drop_features",
    f"""SELECT step, CAST(dense_rank() OVER (ORDER BY type) - 1 AS INT) AS type, amount, oldbalanceOrg,
  newbalanceOrig, oldbalanceDest, newbalanceDest,
  CASE WHEN starts_with(nameDest, 'M') THEN 1 ELSE 0 END AS isMerchant FROM transfers""",
)
def pr12(spark, sf):
    """The notebook feature matrix: codes + merchant flag, ids and labels dropped."""
    t = adapters.transfers(spark, sf).drop("o_orderkey")
    t = encode.category_codes(t, "type").withColumn("isMerchant", F.col("nameDest").startswith("M").cast("int"))
    return encode.drop_features(t, ["isFraud", "isFlaggedFraud", "nameOrig", "nameDest"])


@register(
    "pr12_drop_features_card_behaviour",
    "SELECT * EXCLUDE (fraud, l_orderkey, l_linenumber, year, month, day, hour, minute) FROM card_behaviour",
)
def pr12b(spark, sf):
    """Dataset 2 feature matrix: every column but the label."""
    return encode.drop_features(adapters.card_behaviour(spark, sf), ["fraud", "l_orderkey"])


@register(
    "pr12_drop_features_card_transactions",
    """SELECT bin, amt, CAST(dense_rank() OVER (ORDER BY entry_mode) - 1 AS INT) AS entry_mode, fraud_scenario
FROM card_transactions""",
)
def pr12c(spark, sf):
    """Dataset 3 feature matrix: entry mode codes; ids, time and label dropped."""
    df = encode.category_codes(adapters.card_transactions(spark, sf), "entry_mode")
    return encode.drop_features(df, ["fraud", "transaction_id", "post_ts", "customer_id", "terminal_id"])
