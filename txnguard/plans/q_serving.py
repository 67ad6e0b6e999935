"""Serving queries: SV-1..3, LIM-2."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters
from ..operators import serving, views
from ..session import scratch_path
from ..sinks.views import lookup_view
from .q_batch import AGG1_SQL, AGG4_SQL
from .registry import register


def _published(spark, sf):
    out = scratch_path(spark, "views")
    views.refresh(
        spark,
        {"dataset1": adapters.transfers(spark, sf), "dataset3": adapters.card_transactions(spark, sf)},
        out,
    )
    return out


@register(
    "sv1_sql_over_views",
    f"""SELECT type, fraud_rate, total_transactions FROM ({AGG1_SQL}) v WHERE total_transactions > 100""",
)
def sv1(spark, sf):
    out = _published(spark, sf)
    serving.register_views(spark, out, views.VIEWS)
    return spark.sql(
        "SELECT type, fraud_rate, total_transactions FROM fraud_by_transaction_type "
        "WHERE total_transactions > 100 ORDER BY fraud_rate DESC"
    )


@register("sv2_lookup_by_key", f"SELECT * FROM ({AGG4_SQL}) v WHERE customer_id = 'C8'")
def sv2(spark, sf):
    """From the published view, clustered by its key: one file is read."""
    return lookup_view(spark, _published(spark, sf), "high_risk_customers", "customer_id", "C8")


def _label_predictions(spark, sf):
    """predictions3-shaped rows (fraud = input label, Q8) with event time."""
    ct = adapters.card_transactions(spark, sf)
    return ct.select(
        F.col("transaction_id").alias("id"),
        (F.col("fraud") == 1).alias("fraud"),
        "customer_id",
        F.col("amt").alias("amount"),
        F.to_timestamp_ntz("post_ts").alias("timestamp"),
    )


FLAGGED_SQL = """SELECT transaction_id AS id, fraud = 1 AS fraud, customer_id, amt AS amount,
  CAST(post_ts AS TIMESTAMP) AS timestamp FROM card_transactions WHERE fraud = 1
  ORDER BY timestamp DESC, id LIMIT {n}"""


@register("sv3_flagged_transactions", FLAGGED_SQL.format(n=5000))
def sv3(spark, sf):
    return serving.flagged(_label_predictions(spark, sf))


@register(
    "sv3_flagged_newest_first",
    """SELECT transaction_id AS id, fraud = 1 AS fraud, customer_id, CAST(amt AS REAL) AS amount, CAST(post_ts AS TIMESTAMP) AS timestamp
  FROM card_transactions WHERE fraud = 1 ORDER BY timestamp DESC, id LIMIT 100""",
)
def sv3_sink(spark, sf):
    """SV-3 on a prediction sink that a stream wrote, compacted, read newest day first."""
    from ..sinks import dated
    from .q_streaming import dated_sink

    out = dated_sink(spark, sf, scratch_path(spark, "flagged-sink"))
    dated.compact(spark, out, "9999-01-01")
    return serving.flagged_newest(spark, out, limit=100).drop("date")


@register("lim2_serving_limit", FLAGGED_SQL.format(n=500))
def lim2(spark, sf):
    return serving.flagged(_label_predictions(spark, sf), limit=500)


@register(
    "sv1_sql_over_predictions",
    """SELECT customer_id, count(*) AS predictions,
  CAST(sum(CASE WHEN fraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
  count(*) FILTER (WHERE amt > 100) AS large FROM card_transactions GROUP BY customer_id""",
)
def sv1_predictions(spark, sf):
    """SQL over the predictions3 table written by the dataset-3 scoring stream."""
    import os

    from ..plans.q_streaming import _model, write_records
    from ..sinks import dated
    from ..specs import CARD_TRANSACTIONS
    from ..streaming import score as st

    base = scratch_path(spark, "serving-predictions")
    src = write_records(spark, sf, CARD_TRANSACTIONS, os.path.join(base, "in"))
    out = os.path.join(base, "predictions3")
    st.score(st.read_stream(spark, "files", src), _model(spark, sf, CARD_TRANSACTIONS), CARD_TRANSACTIONS,
             out, os.path.join(base, "checkpoint"), available_now=True).awaitTermination()
    dated.read(spark, out).createOrReplaceTempView("predictions3")
    return spark.sql(
        "SELECT customer_id, count(*) AS predictions, CAST(sum(CASE WHEN fraud THEN 1 ELSE 0 END) AS BIGINT) AS flagged, "
        "count_if(amount > 100) AS large FROM predictions3 GROUP BY customer_id"
    )
