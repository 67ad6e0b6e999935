"""Profiling, filters, ordering and limits: AGG-6..12, FL-1..4, ORD-1, LIM-1, SET-1."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters
from ..operators import ingest, profile
from ..specs import TRANSFERS
from .q_ingest import transfer_records
from .registry import register


def _vc_sql(dataset: str, cols: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM {dataset} "
        f"WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in cols
    ]
    return (
        "SELECT \"column\", value, count, count / sum(count) OVER (PARTITION BY \"column\") AS share FROM ("
        + " UNION ALL ".join(parts)
        + ") u"
    )


CB_FLAGS = ["repeat_retailer", "used_chip", "used_pin_number", "online_order", "fraud"]
CT_CATS = ["entry_mode", "fraud", "fraud_scenario"]


@register("agg6_value_counts_type", _vc_sql("transfers", ["type"]))
def agg6a(spark, sf):
    return profile.value_counts(adapters.transfers(spark, sf), ["type"])


@register("agg6_value_counts_card_behaviour", _vc_sql("card_behaviour", CB_FLAGS))
def agg6b(spark, sf):
    return profile.value_counts(adapters.card_behaviour(spark, sf), CB_FLAGS)


@register("agg6_value_counts_card_transactions", _vc_sql("card_transactions", CT_CATS))
def agg6c(spark, sf):
    return profile.value_counts(adapters.card_transactions(spark, sf), CT_CATS)


@register("agg6_value_counts_pca_class", _vc_sql("pca_card", ["Class"]))
def agg6d(spark, sf):
    return profile.value_counts(adapters.pca_card(spark, sf), ["Class"])


@register("agg7_step_frequency", "SELECT step, count(*) AS count FROM transfers GROUP BY step ORDER BY step")
def agg7(spark, sf):
    return profile.step_frequency(adapters.transfers(spark, sf))


DECODED_COLS = ["year", "month", "day", "hour", "minute"] + [n for n, _ in TRANSFERS.columns]


@register(
    "agg8_missing_values",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {'oldbalanceOrg <= 0' if c == 'amount' else 'false'}) AS BIGINT) AS missing FROM transfers"
        for c in DECODED_COLS
    ),
)
def agg8(spark, sf):
    """Missing values per column of the decoded transfer records."""
    return profile.missing(ingest.decode(transfer_records(spark, sf), TRANSFERS, keep_raw=False))


@register(
    "agg9_describe",
    """SELECT count(x) AS count, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min,
  quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75,
  max(x) AS max FROM (SELECT ratio_to_median_purchase_price AS x FROM card_behaviour) d""",
)
def agg9(spark, sf):
    return profile.describe(adapters.card_behaviour(spark, sf), "ratio_to_median_purchase_price")


@register(
    "agg10_row_counts",
    """SELECT 'dataset 1' AS dataset, count(*) AS rows FROM transfers
UNION ALL SELECT 'dataset 2', count(*) FROM card_behaviour
UNION ALL SELECT 'dataset 3', count(*) FROM card_transactions
UNION ALL SELECT 'dataset 4', count(*) FROM pca_card""",
)
def agg10(spark, sf):
    parts = [
        profile.row_count(df).select(F.lit(name).alias("dataset"), "rows")
        for name, df in _datasets(spark, sf)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _datasets(spark, sf):
    return [
        ("dataset 1", adapters.transfers(spark, sf)),
        ("dataset 2", adapters.card_behaviour(spark, sf)),
        ("dataset 3", adapters.card_transactions(spark, sf)),
        ("dataset 4", adapters.pca_card(spark, sf)),
    ]


_LABELS = {"dataset 1": "isFraud", "dataset 2": "fraud", "dataset 3": "fraud", "dataset 4": "Class"}


@register(
    "agg11_fraud_share",
    " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS rows, CAST(sum({lab}) AS BIGINT) AS frauds, "
        f"sum({lab}) * 100.0 / count(*) AS fraud_pct FROM {tbl}"
        for name, lab, tbl in [
            ("dataset 1", "isFraud", "transfers"),
            ("dataset 2", "fraud", "card_behaviour"),
            ("dataset 3", "fraud", "card_transactions"),
            ("dataset 4", "Class", "pca_card"),
        ]
    ),
)
def agg11(spark, sf):
    return profile.fraud_share([(n, df, _LABELS[n]) for n, df in _datasets(spark, sf)])


IQR_SQL = """
SELECT {cols} FROM {t}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t}) q
WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1) AND {c} > 0
"""


def _iqr(t, c, cols):
    return IQR_SQL.format(t=t, c=c, cols=cols)


# Linear binning: each value's weight goes to the two centres beside it, by nearness.
DENSITY_SQL = """
, kept AS ({kept}),
stats AS (SELECT count(*) AS n, stddev_samp(x) AS sd, min(x) AS lo, max(x) AS hi,
  stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h FROM kept),
placed AS (SELECT (x - lo) / (h / 20) AS t FROM kept, stats),
centres AS (SELECT b, sum(w) AS w FROM (
  SELECT floor(t) AS b, 1 - (t - floor(t)) AS w FROM placed UNION ALL SELECT floor(t) + 1, t - floor(t) FROM placed) GROUP BY b),
grid AS (SELECT g, (lo - 3 * h) + g * ((hi + 3 * h) - (lo - 3 * h)) / 199 AS x, n, h, lo, hi
  FROM stats, range(200) r(g)),
near AS (SELECT g, x, w, n, h, (x - (lo + b * (h / 20))) / h AS z FROM grid, centres)
SELECT CAST(g AS INT) AS g, x, coalesce(sum(w * exp(-0.5 * z * z)) FILTER (abs(z) <= 8), 0) / (n * h * sqrt(2 * pi())) AS density
FROM near GROUP BY g, x, n, h
"""


@register("fl1_zero_amount", "SELECT * EXCLUDE (year, month, day, hour, minute) FROM transfers WHERE amount = 0")
def fl1(spark, sf):
    return profile.zero_amount(adapters.transfers(spark, sf))


@register(
    "fl1_zero_new_balance",
    "SELECT * EXCLUDE (year, month, day, hour, minute) FROM transfers WHERE newbalanceOrig = 0",
)
def fl1b(spark, sf):
    """FL-1's filter on a column that has zeros in the test data."""
    return profile.zero_amount(adapters.transfers(spark, sf), "newbalanceOrig")


@register(
    "fl2_merchant_share",
    """SELECT count(*) FILTER (WHERE starts_with(nameDest, 'M')) AS matching, count(*) AS rows,
  round(count(*) FILTER (WHERE starts_with(nameDest, 'M')) * 100.0 / count(*), 2) AS pct FROM transfers""",
)
def fl2(spark, sf):
    return profile.prefix_share(adapters.transfers(spark, sf), "nameDest", "M")


@register("fl3_remove_outliers_amt", _iqr("card_transactions", "amt", "transaction_id, amt"))
def fl3(spark, sf):
    return profile.remove_outliers(adapters.card_transactions(spark, sf), "amt").select("transaction_id", "amt")


@register("fl3_remove_outliers_amount", _iqr("transfers", "amount", "o_orderkey, amount"))
def fl3b(spark, sf):
    return profile.remove_outliers(adapters.transfers(spark, sf), "amount").select("o_orderkey", "amount")


@register(
    "fl3_remove_outliers_ratio",
    _iqr("card_behaviour", "ratio_to_median_purchase_price", "l_orderkey, ratio_to_median_purchase_price"),
)
def fl3c(spark, sf):
    df = profile.remove_outliers(adapters.card_behaviour(spark, sf), "ratio_to_median_purchase_price")
    return df.select("l_orderkey", "ratio_to_median_purchase_price")


@register(
    "fl4_fraud_rows",
    """SELECT CAST(sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS frauds, count(*) AS rows,
  sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) * 100.0 / count(*) AS fraud_pct FROM transfers""",
)
def fl4(spark, sf):
    return profile.fraud_rows(adapters.transfers(spark, sf))


@register(
    "agg12_amount_density",
    DENSITY_SQL.format(kept=_iqr("card_transactions", "amt", "amt AS x")),
)
def agg12(spark, sf):
    """Density of dataset 3 amounts after outlier removal (the notebook's KDE)."""
    kept = profile.remove_outliers(adapters.card_transactions(spark, sf), "amt")
    return profile.density(kept, "amt")


@register(
    "lim1_preview",
    "SELECT * EXCLUDE (year, month, day, hour, minute) FROM transfers ORDER BY o_orderkey LIMIT 5",
)
def lim1(spark, sf):
    return profile.preview(adapters.transfers(spark, sf), ["o_orderkey"], 5)


@register(
    "ord1_value_counts_sorted",
    "SELECT type, count(*) AS count FROM transfers GROUP BY type ORDER BY count DESC, type",
)
def ord1(spark, sf):
    return (
        adapters.transfers(spark, sf)
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "type")
    )


@register(
    "agg12_amount_density_transfers",
    DENSITY_SQL.format(kept=_iqr("transfers", "amount", "amount AS x")),
)
def agg12b(spark, sf):
    kept = profile.remove_outliers(adapters.transfers(spark, sf), "amount")
    return profile.density(kept, "amount")


@register(
    "agg12_ratio_density_card_behaviour",
    DENSITY_SQL.format(kept=_iqr("card_behaviour", "ratio_to_median_purchase_price", "ratio_to_median_purchase_price AS x")),
)
def agg12c(spark, sf):
    kept = profile.remove_outliers(adapters.card_behaviour(spark, sf), "ratio_to_median_purchase_price")
    return profile.density(kept, "ratio_to_median_purchase_price")


@register(
    "lim1_preview_card_behaviour",
    "SELECT * EXCLUDE (year, month, day, hour, minute, l_linenumber) FROM card_behaviour "
    "ORDER BY l_orderkey, distance_from_home, distance_from_last_transaction, ratio_to_median_purchase_price LIMIT 5",
)
def lim1b(spark, sf):
    return profile.preview(
        adapters.card_behaviour(spark, sf),
        ["l_orderkey", "distance_from_home", "distance_from_last_transaction", "ratio_to_median_purchase_price"],
    )


@register(
    "lim1_preview_card_transactions",
    "SELECT * EXCLUDE (year, month, day, hour, minute, event_id, ts) FROM card_transactions "
    "ORDER BY post_ts, transaction_id LIMIT 5",
)
def lim1c(spark, sf):
    return profile.preview(adapters.card_transactions(spark, sf), ["post_ts", "transaction_id"])


@register("lim1_preview_pca", "SELECT * FROM pca_card ORDER BY Time LIMIT 5")
def lim1d(spark, sf):
    return profile.preview(adapters.pca_card(spark, sf), ["Time"])
