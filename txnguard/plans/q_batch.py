"""Batch views (AGG-1..5), sources (SRC-3..5, SRC-7) and sinks (SNK-1, SNK-4, SNK-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters
from ..operators import views
from ..session import scratch_path
from ..sinks.views import read_view
from .registry import register

_VIEW_MEASURES = """
  count(*) AS total_transactions,
  CAST(sum(CASE WHEN {label} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS {fraud},
  {amount_agg}
"""


def _m(label, fraud, amount_agg):
    return _VIEW_MEASURES.format(label=label, fraud=fraud, amount_agg=amount_agg)


AGG1_SQL = f"""
SELECT type, {_m('isFraud', 'total_fraudulent', 'avg(amount) AS avg_amount')},
  CAST(sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS fraud_rate
FROM transfers GROUP BY type
"""

BUCKET_SQL = """CASE WHEN amount <= 1000 THEN '0-1000' WHEN amount <= 10000 THEN '1000-10000'
    WHEN amount <= 50000 THEN '10000-50000' WHEN amount <= 100000 THEN '50000-100000'
    WHEN amount <= 500000 THEN '100000-500000' ELSE '500000+' END"""

AGG2_SQL = f"""
SELECT {BUCKET_SQL} AS amount_bucket, {_m('isFraud', 'total_fraudulent', 'avg(amount) AS avg_amount')},
  CAST(sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS fraud_rate
FROM transfers GROUP BY 1
"""

HOUR_SQL = "CAST(hour(try_strptime(post_ts, '%Y-%m-%d %H:%M:%S')) AS INT)"

AGG3_SQL = f"""
SELECT {HOUR_SQL} AS hour, {_m('fraud', 'total_fraudulent', 'avg(amt) AS avg_amount')}
FROM card_transactions GROUP BY 1
"""

AGG4_SQL = f"""
SELECT customer_id, {_m('fraud', 'fraudulent_transactions', 'sum(amt) AS total_amount')},
  CAST(sum(CASE WHEN fraud = 1 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS fraud_rate
FROM card_transactions GROUP BY customer_id
"""


@register("agg1_fraud_by_type", AGG1_SQL)
def agg1(spark, sf):
    return views.fraud_by_type(adapters.transfers(spark, sf))


@register("agg2_fraud_by_amount_bucket", AGG2_SQL)
def agg2(spark, sf):
    return views.fraud_by_amount(adapters.transfers(spark, sf))


@register("agg3_hourly_fraud_stats", AGG3_SQL)
def agg3(spark, sf):
    return views.hourly(adapters.card_transactions(spark, sf))


@register("agg4_customer_risk", AGG4_SQL)
def agg4(spark, sf):
    return views.customer_risk(adapters.card_transactions(spark, sf))


def _refresh_all(spark, sf):
    out = scratch_path(spark, "views")
    views.refresh(
        spark,
        {
            "dataset1": lambda: adapters.transfers(spark, sf),
            "dataset3": lambda: adapters.card_transactions(spark, sf),
        },
        out,
    )
    return out


@register(
    "agg5_refresh_views",
    f"""
SELECT 'fraud_by_transaction_type' AS view, count(*) AS view_rows,
  CAST(sum(total_transactions) AS BIGINT) AS transactions FROM ({AGG1_SQL}) a
UNION ALL SELECT 'fraud_by_amount_bucket', count(*), CAST(sum(total_transactions) AS BIGINT) FROM ({AGG2_SQL}) b
UNION ALL SELECT 'hourly_fraud_stats', count(*), CAST(sum(total_transactions) AS BIGINT) FROM ({AGG3_SQL}) c
UNION ALL SELECT 'high_risk_customers', count(*), CAST(sum(total_transactions) AS BIGINT) FROM ({AGG4_SQL}) d
""",
)
def agg5(spark, sf):
    """Refresh all four views, then report each published view's size."""
    out = _refresh_all(spark, sf)
    parts = [
        read_view(spark, out, v).agg(
            F.lit(v).alias("view"),
            F.count(F.lit(1)).alias("view_rows"),
            F.sum("total_transactions").cast("long").alias("transactions"),
        )
        for v in views.VIEWS
    ]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


@register("snk1_view_published", AGG1_SQL)
def snk1(spark, sf):
    """The fraud-by-type view as published by the atomic refresh (read back)."""
    out = scratch_path(spark, "views")
    views.refresh(spark, {"dataset1": adapters.transfers(spark, sf), "dataset3": None}, out)
    return read_view(spark, out, "fraud_by_transaction_type")


def _land_to_catalog(spark, sf, database: str) -> None:
    """Land datasets 1 and 3 by arrival date and register them as external
    partitioned tables of ``database`` (the batch layer's Hive tables)."""
    import os

    from ..operators import ingest
    from ..sinks.files import land
    from ..sources.files import ensure_database, register_partitioned_table
    from ..specs import CARD_TRANSACTIONS, TRANSFERS

    base = scratch_path(spark, "warehouse")
    ensure_database(spark, database, os.path.join(base, f"{database}.db"))
    for name, spec, load in (
        ("dataset1", TRANSFERS, adapters.transfers),
        ("dataset3", CARD_TRANSACTIONS, adapters.card_transactions),
    ):
        path = os.path.join(base, name)
        cols = [n for n, _ in spec.columns] + ["year", "month", "day"]
        land(ingest.conform(load(spark, sf, tags=True), spec).select(*cols), path)
        register_partitioned_table(spark, name, path, spec, database)


def _own_database(prefix: str) -> str:
    """A name that no other run or user of the catalog has."""
    import uuid

    return f"{prefix}_{uuid.uuid4().hex[:12]}"


_REAL_VIEW_SQL = {
    "fraud_by_transaction_type": AGG1_SQL.replace("avg(amount)", "avg(CAST(amount AS REAL))"),
    "fraud_by_amount_bucket": AGG2_SQL.replace("avg(amount)", "avg(CAST(amount AS REAL))").replace(
        "CASE WHEN amount", "CASE WHEN CAST(amount AS REAL)").replace(
        "WHEN amount <=", "WHEN CAST(amount AS REAL) <="),
    "hourly_fraud_stats": AGG3_SQL.replace("avg(amt)", "avg(CAST(amt AS REAL))"),
    "high_risk_customers": AGG4_SQL.replace("sum(amt)", "sum(CAST(amt AS REAL))"),
}


@register(
    "src3_agg5_batch_layer",
    " UNION ALL ".join(
        f"SELECT '{v}' AS view, count(*) AS view_rows, CAST(sum(total_transactions) AS BIGINT) AS transactions, "
        f"sum({'total_amount' if v == 'high_risk_customers' else 'avg_amount * total_transactions'}) AS amount "
        f"FROM ({sql}) x"
        for v, sql in _REAL_VIEW_SQL.items()
    ),
)
def batch_layer(spark, sf):
    """The reference's batch layer end to end: typed landing (FLOAT columns),
    catalog tables ``dataset1/3`` of a database (SRC-3, SRC-4), then the refresh reading
    them through the catalog, skipping a missing table (AGG-5, SNK-1)."""
    from ..sources.files import read_table

    database = _own_database("fraud")
    _land_to_catalog(spark, sf, database)
    out = scratch_path(spark, "views")
    views.refresh(
        spark,
        {
            "dataset1": lambda: read_table(spark, "dataset1", database),
            "dataset3": lambda: read_table(spark, "dataset3", database),
        },
        out,
    )
    spark.sql(f"DROP DATABASE {database} CASCADE")  # its own, with external tables: files stay
    return _view_sums(spark, out)


def _view_sums(spark, out):
    parts = []
    for v in views.VIEWS:
        df = read_view(spark, out, v)
        amount = F.col("total_amount") if v == "high_risk_customers" else F.col("avg_amount") * F.col("total_transactions")
        parts.append(
            df.agg(
                F.lit(v).alias("view"),
                F.count(F.lit(1)).alias("view_rows"),
                F.sum("total_transactions").cast("long").alias("transactions"),
                F.sum(amount).alias("amount"),
            )
        )
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


@register(
    "agg5_refresh_changed_days",
    " UNION ALL ".join(
        f"SELECT '{v}' AS view, count(*) AS view_rows, CAST(sum(total_transactions) AS BIGINT) AS transactions, "
        f"sum({'total_amount' if v == 'high_risk_customers' else 'avg_amount * total_transactions'}) AS amount "
        f"FROM ({sql}) x"
        for v, sql in _REAL_VIEW_SQL.items()
    ),
)
def agg5_days(spark, sf):
    """AGG-5 by date range: the views from one half of the landed rows, then the other half
    lands and only its days are read and aggregated again."""
    import os

    from ..operators import ingest
    from ..operators.ml import split
    from ..sinks.files import land
    from ..sources.files import read_partitioned
    from ..specs import CARD_TRANSACTIONS, TRANSFERS

    base, out = scratch_path(spark, "landed-days"), scratch_path(spark, "views")
    halves, paths = {}, {}
    for src, spec, load, key in (
        ("dataset1", TRANSFERS, adapters.transfers, "nameDest"),
        ("dataset3", CARD_TRANSACTIONS, adapters.card_transactions, "transaction_id"),
    ):
        cols = [n for n, _ in spec.columns] + ["year", "month", "day"]
        halves[src] = split(ingest.conform(load(spark, sf, tags=True), spec).select(*cols), [key], 0.5, 11)
        paths[src] = (os.path.join(base, src), spec)
        land(halves[src][0], paths[src][0])
    sources = {src: lambda p=p: read_partitioned(spark, *p) for src, p in paths.items()}
    views.refresh_days(spark, sources, out)
    for src, (_, later) in halves.items():
        day = views.day_of()
        # The newest third of the second half lands later than the rest.
        days = sorted(r[0] for r in later.select(day).distinct().collect())
        for part in (days[: 2 * len(days) // 3], days[2 * len(days) // 3 :]):
            land(later.where(day.isin(part)), paths[src][0])
            views.refresh_days(spark, {src: sources[src]}, out, part)
    return _view_sums(spark, out)
