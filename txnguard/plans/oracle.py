"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The adapter CTEs restate txnguard.adapters in DuckDB's dialect. Each query
text below computes the same columns, with the same names, as its Spark twin.
"""

from __future__ import annotations

TRANSFERS = """
SELECT CAST(o_orderkey % 744 AS INT) + 1 AS step,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'CASH-IN' WHEN '2-HIGH' THEN 'CASH_OUT'
    WHEN '3-MEDIUM' THEN 'DEBIT' WHEN '4-NOT SPECIFIED' THEN 'PAYMENT' ELSE 'TRANSFER' END AS type,
  o_totalprice * o_totalprice / 400000 AS amount,
  concat('C', CAST(o_custkey AS VARCHAR)) AS nameOrig,
  c_acctbal AS oldbalanceOrg,
  greatest(c_acctbal - o_totalprice * o_totalprice / 400000, CAST(0 AS DOUBLE)) AS newbalanceOrig,
  concat(CASE WHEN o_orderkey % 3 = 0 THEN 'M' ELSE 'C' END, CAST(o_orderkey AS VARCHAR)) AS nameDest,
  CAST(0 AS DOUBLE) AS oldbalanceDest, CAST(0 AS DOUBLE) AS newbalanceDest,
  CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN 1 ELSE 0 END AS isFraud,
  CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice * o_totalprice / 400000 > 200000
    THEN 1 ELSE 0 END AS isFlaggedFraud,
  o_orderkey,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(o_orderkey), '%Y') AS year,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(o_orderkey), '%m') AS month,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(o_orderkey), '%d') AS day,
  CAST(CAST(floor(o_orderkey / 60.0) % 24 AS INT) AS VARCHAR) AS hour,
  CAST(CAST(o_orderkey % 60 AS INT) AS VARCHAR) AS minute
FROM orders JOIN customer ON o_custkey = c_custkey
"""

CARD_BEHAVIOUR = """
SELECT l_quantity AS distance_from_home, l_tax * 100 AS distance_from_last_transaction,
  l_extendedprice / (p_retailprice * l_quantity) AS ratio_to_median_purchase_price,
  CASE WHEN l_linenumber > 1 THEN 1 ELSE 0 END AS repeat_retailer,
  CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS used_chip,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS used_pin_number,
  CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS online_order,
  CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN 1 ELSE 0 END AS fraud,
  l_orderkey, l_linenumber,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(l_orderkey), '%Y') AS year,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(l_orderkey), '%m') AS month,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(l_orderkey), '%d') AS day,
  CAST(CAST(floor(l_orderkey / 60.0) % 24 AS INT) AS VARCHAR) AS hour,
  CAST(CAST(l_orderkey % 60 AS INT) AS VARCHAR) AS minute
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

CARD_TRANSACTIONS = """
SELECT concat('X', CAST(event_id AS VARCHAR)) AS transaction_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS post_ts,
  concat('C', CAST(user_id AS VARCHAR)) AS customer_id, CAST(400000 + user_id AS INT) AS bin,
  concat('T', CAST(event_id % 50 AS VARCHAR)) AS terminal_id, value AS amt,
  CASE event_type WHEN 'view' THEN 'Contactless' WHEN 'click' THEN 'Chip'
    WHEN 'purchase' THEN 'Swipe' ELSE event_type END AS entry_mode,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fraud,
  CAST(CASE WHEN event_type = 'error' THEN 1 + event_id % 2 ELSE 0 END AS INT) AS fraud_scenario,
  event_id,
  strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
  CAST(hour(ts) AS VARCHAR) AS hour, CAST(minute(ts) AS VARCHAR) AS minute,
  ts
FROM events
"""

PCA_CARD = (
    "SELECT CAST(vec_id AS DOUBLE) AS Time, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS V{i + 1}" for i in range(28))
    + ", CAST(vec_id AS DOUBLE) * 1.5 AS Amount, CASE WHEN label = 0 THEN 1 ELSE 0 END AS Class FROM embeddings"
)

CTES = (
    f"WITH transfers AS ({TRANSFERS}),\n"
    f"card_behaviour AS ({CARD_BEHAVIOUR}),\n"
    f"card_transactions AS ({CARD_TRANSACTIONS}),\n"
    f"pca_card AS ({PCA_CARD})\n"
)


def q(body: str) -> str:
    """Prefix a query body with the adapter CTEs."""
    return CTES + body
