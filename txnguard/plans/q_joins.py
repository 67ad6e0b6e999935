"""Joins: JOIN-1 (as written, factorized), JOIN-2 (bounded by the full arrival
minute), JOIN-3 (customer enrichment), plus the profile build it needs (EXT-1)."""

from __future__ import annotations

from .. import adapters
from ..operators import extensions, joins
from .registry import register

MINUTE = ["hour", "minute"]
FULL_MINUTE = ["year", "month", "day", "hour", "minute"]


def _streams(spark, sf, keys):
    a = adapters.transfers(spark, sf, tags=True).select(*keys)
    b = adapters.card_behaviour(spark, sf, tags=True).select(*keys)
    c = adapters.card_transactions(spark, sf, tags=True).select("transaction_id", "customer_id", *keys)
    return a, b, c


def _counts_sql(keys):
    k = ", ".join(keys)
    using = ", ".join(keys)
    return f"""
SELECT {k}, n1, n2, n3, n1 * n2 * n3 AS n_joined FROM
  (SELECT {k}, count(*) AS n1 FROM transfers GROUP BY ALL) a
  JOIN (SELECT {k}, count(*) AS n2 FROM card_behaviour GROUP BY ALL) b USING ({using})
  JOIN (SELECT {k}, count(*) AS n3 FROM card_transactions GROUP BY ALL) c USING ({using})
"""


def _rows_sql(keys):
    k = ", ".join(keys)
    using = ", ".join(keys)
    return f"""
SELECT transaction_id, customer_id, {k}, n1 * n2 AS n_joined FROM card_transactions
  JOIN (SELECT {k}, count(*) AS n1 FROM transfers GROUP BY ALL) a USING ({using})
  JOIN (SELECT {k}, count(*) AS n2 FROM card_behaviour GROUP BY ALL) b USING ({using})
"""


@register("join1_stream_join_key_counts", _counts_sql(MINUTE))
def join1_counts(spark, sf):
    """Three-way join on (hour, minute) as written: size per key, n1*n2*n3."""
    a, b, c = _streams(spark, sf, MINUTE)
    return joins.key_counts(a, b, c.select(*MINUTE), MINUTE, bounded_keys=True)


@register("join1_stream_join_rows", _rows_sql(MINUTE))
def join1_rows(spark, sf):
    """The joined output (transaction_id, customer_id of dataset 3) factorized:
    each dataset-3 row with the number of joined rows it appears in."""
    a, b, c = _streams(spark, sf, MINUTE)
    return joins.join3_rows(a, b, c, MINUTE, side="c", bounded_keys=True).select(
        "transaction_id", "customer_id", *MINUTE, "n_joined"
    )


@register("join2_bounded_join_key_counts", _counts_sql(FULL_MINUTE))
def join2_counts(spark, sf):
    """Bounded variant: the key is the full arrival minute, so pairs never
    cross days and state can expire behind a watermark (Q17)."""
    a, b, c = _streams(spark, sf, FULL_MINUTE)
    return joins.key_counts(a, b, c.select(*FULL_MINUTE), FULL_MINUTE)


@register("join2_bounded_join_rows", _rows_sql(FULL_MINUTE))
def join2_rows(spark, sf):
    a, b, c = _streams(spark, sf, FULL_MINUTE)
    return joins.join3_rows(a, b, c, FULL_MINUTE, side="c").select(
        "transaction_id", "customer_id", *FULL_MINUTE, "n_joined"
    )


PROFILE_SQL = """
SELECT customer_id, avg(amt) AS mean_amount, stddev_samp(amt) AS std_amount,
  count(*) / count(DISTINCT CAST(strptime(post_ts, '%Y-%m-%d %H:%M:%S') AS DATE)) AS mean_nb_tx_per_day
FROM card_transactions GROUP BY customer_id
"""


@register("ext1_customer_profiles", PROFILE_SQL)
def ext1(spark, sf):
    return extensions.customer_profiles(adapters.card_transactions(spark, sf))


@register(
    "join3_customer_enrichment",
    f"""SELECT t.transaction_id, t.customer_id, t.amt, p.mean_amount, p.std_amount, p.mean_nb_tx_per_day
FROM card_transactions t LEFT JOIN ({PROFILE_SQL}) p USING (customer_id)""",
)
def join3(spark, sf):
    tx = adapters.card_transactions(spark, sf)
    return joins.enrich(tx.select("transaction_id", "customer_id", "amt"), extensions.customer_profiles(tx))


@register(
    "ext2_terminal_risk",
    """SELECT terminal_id, count(*) AS total_transactions,
  CAST(sum(CASE WHEN fraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fraudulent_transactions,
  sum(amt) AS total_amount,
  CAST(sum(CASE WHEN fraud = 1 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS fraud_rate
FROM card_transactions GROUP BY terminal_id""",
)
def ext2(spark, sf):
    return extensions.terminal_risk(adapters.card_transactions(spark, sf))


@register(
    "ext3_rolling_customer_stats",
    """SELECT transaction_id, customer_id, amt,
  count(*) OVER w AS rolling_count, avg(amt) OVER w AS rolling_mean_amount
FROM (SELECT *, epoch(strptime(post_ts, '%Y-%m-%d %H:%M:%S'))::BIGINT AS t FROM card_transactions) d
WINDOW w AS (PARTITION BY customer_id ORDER BY t RANGE BETWEEN 604799 PRECEDING AND CURRENT ROW)""",
)
def ext3(spark, sf):
    df = extensions.rolling_customer_stats(adapters.card_transactions(spark, sf), window_days=7)
    return df.select("transaction_id", "customer_id", "amt", "rolling_count", "rolling_mean_amount")
