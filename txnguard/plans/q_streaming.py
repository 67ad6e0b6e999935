"""Streaming: SRC-1, ST-1..8, SNK-2, PR-13..15 over replayed record files.

Each query writes the dataset's records as JSON lines under the shared scratch
area, runs the streaming job with an ``availableNow`` trigger (all available
input, then stop), and returns the sink's output read back as a batch frame.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from .. import adapters
from ..operators import ingest, ml
from ..session import scratch_path
from ..sinks import cells, dated
from ..sinks.views import read_view, replace_view
from ..specs import CARD_BEHAVIOUR, CARD_TRANSACTIONS, TRANSFERS
from ..streaming import score as st
from .registry import register

_LOADERS = {
    TRANSFERS.name: adapters.transfers,
    CARD_BEHAVIOUR.name: adapters.card_behaviour,
    CARD_TRANSACTIONS.name: adapters.card_transactions,
}


def write_records(spark, sf, spec, path):
    """Land a dataset's rows as stream records (one JSON object per line), compressed:
    plain ones take several times the table's own size. Readers tell by the file's name."""
    df = _LOADERS[spec.name](spark, sf, tags=True)
    ingest.encode_json(df, spec).write.text(path, compression="snappy")
    return path


def _model(spark, sf, spec):
    feats = ml.features_for(_LOADERS[spec.name](spark, sf), spec).select("features", spec.label)
    return ml.train(feats, spec.label, 42)


def _score_stream(spark, sf, spec):
    base = scratch_path(spark, f"stream-{spec.name}")
    src = write_records(spark, sf, spec, os.path.join(base, "in"))
    model = _model(spark, sf, spec)
    q = st.score(
        st.read_stream(spark, "files", src), model, spec,
        os.path.join(base, "out"), os.path.join(base, "checkpoint"), available_now=True,
    )
    q.awaitTermination()
    return dated.read(spark, os.path.join(base, "out")).drop("date")


@register("st1_score_transfers_stream")
def st1(spark, sf):
    """SRC-1 -> SRC-2 -> PR-1 -> AS-1 -> ML-2 -> PR-13 -> SNK-2 (predictions1)."""
    return _score_stream(spark, sf, TRANSFERS)


@register("st2_score_card_behaviour_stream")
def st2(spark, sf):
    """predictions2 (PR-14)."""
    return _score_stream(spark, sf, CARD_BEHAVIOUR)


@register("st3_score_card_transactions_stream")
def st3(spark, sf):
    """predictions3 (PR-15)."""
    return _score_stream(spark, sf, CARD_TRANSACTIONS)


def _join_sources(spark, sf, base):
    specs = (TRANSFERS, CARD_BEHAVIOUR, CARD_TRANSACTIONS)
    return [
        (st.read_stream(spark, "files", write_records(spark, sf, s, os.path.join(base, f"in-{s.name}"))), s)
        for s in specs
    ]


@register(
    "st4_join_stream_as_written",
    """SELECT CAST(hour AS VARCHAR) AS hour, CAST(minute AS VARCHAR) AS minute, n1, n2, n3, n1 * n2 * n3 AS n_joined
FROM (SELECT hour, minute, count(*) AS n1 FROM transfers GROUP BY ALL) a
JOIN (SELECT hour, minute, count(*) AS n2 FROM card_behaviour GROUP BY ALL) b USING (hour, minute)
JOIN (SELECT hour, minute, count(*) AS n3 FROM card_transactions GROUP BY ALL) c USING (hour, minute)""",
)
def st4_as_written(spark, sf):
    """ST-4 with JOIN-1: the (hour, minute) join of the three streams as running
    per-key counts. State holds at most 1,440 keys; every micro-batch publishes
    the complete table atomically (idempotent on retry)."""
    base = scratch_path(spark, "stream-join")
    counts = st.join_counts_stream(_join_sources(spark, sf, base), bounded=False)
    out = os.path.join(base, "views")
    q = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", os.path.join(base, "checkpoint"))
        .foreachBatch(lambda df, _: replace_view(df.sparkSession, df, out, "predictions4_counts"))
        .trigger(availableNow=True)
        .queryName("join-as-written")
        .start()
    )
    q.awaitTermination()
    return read_view(spark, out, "predictions4_counts")


_ARRIVALS = " UNION ALL ".join(
    f"SELECT make_timestamp(CAST(year AS INT), CAST(month AS INT), CAST(day AS INT), CAST(hour AS INT), "
    f"CAST(minute AS INT), 0) AS arrival, '{side}' AS side FROM {t}"
    for side, t in (("n1", "transfers"), ("n2", "card_behaviour"), ("n3", "card_transactions"))
)


_MINUTES = f"""SELECT arrival, n1, n2, n3, n1 * n2 * n3 AS n_joined FROM (
  SELECT arrival, count(*) FILTER (WHERE side = 'n1') AS n1, count(*) FILTER (WHERE side = 'n2') AS n2,
    count(*) FILTER (WHERE side = 'n3') AS n3
  FROM ({_ARRIVALS}) u GROUP BY arrival) g
WHERE n1 > 0 AND n2 > 0 AND n3 > 0"""


def _closed_sources(spark, sf, base):
    """The three record streams, each followed by one record a day after all data:
    it closes every minute, as live traffic does."""
    sources = _join_sources(spark, sf, base)
    for spec in (TRANSFERS, CARD_BEHAVIOUR, CARD_TRANSACTIONS):
        closing = '{"year":"2099","month":"01","day":"01","hour":"0","minute":"0"}'
        spark.createDataFrame([(closing,)], "value string").coalesce(1).write.mode("append").text(os.path.join(base, f"in-{spec.name}"))
    return sources


@register("st4_join_stream_bounded", _MINUTES)
def st4_bounded(spark, sf):
    """ST-4 with JOIN-2: per full arrival minute behind a 10-minute watermark;
    closed minutes are appended once and their state dropped. A later record on
    each stream closes all minutes of the data."""
    base = scratch_path(spark, "stream-join-bounded")
    counts = st.join_counts_stream(_closed_sources(spark, sf, base), bounded=True)
    q = st.start_sink(
        counts, os.path.join(base, "out"), os.path.join(base, "checkpoint"), "join-bounded", available_now=True
    )
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out"))
    return out.withColumn("arrival", F.col("arrival").cast("timestamp_ntz"))


@register(
    "st4_join_stream_rows",
    f"""SELECT transaction_id, customer_id, make_timestamp(CAST(year AS INT), CAST(month AS INT), CAST(day AS INT),
  CAST(hour AS INT), CAST(minute AS INT), 0) AS arrival, n1 * n2 AS n_joined
FROM card_transactions JOIN ({_MINUTES}) m ON arrival = make_timestamp(CAST(year AS INT), CAST(month AS INT),
  CAST(day AS INT), CAST(hour AS INT), CAST(minute AS INT), 0)""",
)
def st4_rows(spark, sf):
    """ST-4's row output: each dataset-3 record of the join once, with the number of
    joined rows that it stands in (never the pairs themselves)."""
    base = scratch_path(spark, "stream-join-rows")
    rows = st.join_rows_stream(_closed_sources(spark, sf, base))
    q = st.start_sink(rows, os.path.join(base, "out"), os.path.join(base, "checkpoint"), "join-rows", available_now=True)
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out"))
    return out.select("transaction_id", "customer_id", F.col("arrival").cast("timestamp_ntz").alias("arrival"), "n_joined")


@register(
    "st6_restart_no_duplicates",
    "SELECT count(*) AS rows, count(*) AS distinct_ids FROM card_transactions",
)
def st6(spark, sf):
    """Two runs on one checkpoint: the second only sees files added since the
    first, so the sink holds every valid record exactly once."""
    spec = CARD_TRANSACTIONS
    base = scratch_path(spark, "stream-restart")
    df = adapters.card_transactions(spark, sf, tags=True)
    records = ingest.encode_json(df, spec)
    first, second = ml.split(records, ["value"], 0.5, 7)
    src = os.path.join(base, "in")
    first.write.text(os.path.join(src, "part1"))
    model = _model(spark, sf, spec)
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "checkpoint")

    def run():
        stream = st.read_stream(spark, "files", os.path.join(src, "*"))
        st.score(stream, model, spec, out, ckpt, available_now=True).awaitTermination()

    run()
    second.write.text(os.path.join(src, "part2"))
    run()
    got = dated.read(spark, out)
    return got.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("id").alias("distinct_ids"),
    )


@register(
    "st7_run_all_streams",
    """SELECT 'transfers' AS sink, count(*) AS rows FROM transfers
UNION ALL SELECT 'card_behaviour', count(*) FROM card_behaviour
UNION ALL SELECT 'card_transactions', count(*) FROM card_transactions""",
)
def st7(spark, sf):
    """The speed layer as one job (ST-1..4, ST-7): newest complete model
    version, three scoring queries and the bounded join started together,
    waited for and stopped; reports the rows each prediction sink received."""
    from ..jobs import MODEL_SPECS, speed_layer
    from ..sinks.models import save

    base = scratch_path(spark, "stream-all")
    models = os.path.join(base, "models")
    sources = {}
    for name, spec in MODEL_SPECS.items():
        save(_model(spark, sf, spec), models, name, "20250101_000000")
        src = write_records(spark, sf, spec, os.path.join(base, f"in-{spec.name}"))
        sources[name] = {"kind": "files", "path": src}
    out = os.path.join(base, "out")
    speed_layer(spark, models, sources, out, os.path.join(base, "checkpoints"), available_now=True)
    parts = [
        dated.read(spark, os.path.join(out, f"predictions_{spec.name}"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("sink", F.lit(spec.name))
        for spec in MODEL_SPECS.values()
    ]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


@register("st5_processing_time_trigger", "SELECT count(*) AS rows, count(*) AS ids, true AS stamped FROM card_transactions")
def st5(spark, sf):
    """The scoring query on a processing-time trigger (1 s here; 30 s is the
    default): drain everything available, then stop (ST-5, ST-8)."""
    spec = CARD_TRANSACTIONS
    base = scratch_path(spark, "stream-trigger")
    src = write_records(spark, sf, spec, os.path.join(base, "in"))
    q = st.score(
        st.read_stream(spark, "files", src, max_files_per_trigger=2), _model(spark, sf, spec), spec,
        os.path.join(base, "out"), os.path.join(base, "checkpoint"), trigger="1 second",
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    out = dated.read(spark, os.path.join(base, "out"))
    # One processing time per micro-batch, within the last hour (ST-8).
    stamped = F.col("timestamp").between(F.current_timestamp() - F.expr("INTERVAL 1 HOUR"), F.current_timestamp())
    return out.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"), F.bool_and(stamped).alias("stamped"))


def _projected(out):
    """A projection's columns that don't depend on the fit, and whether the rest agree."""
    p = F.col("fraud_probability")
    ok = p.between(0.0, 1.0)
    if "prediction" in out.columns:
        ok = ok & (F.col("fraud") == (F.col("prediction") == 1))
    fitted = ["fraud", "prediction"] if "prediction" in out.columns else []
    return out.withColumn("scores_ok", ok).drop(*fitted, "fraud_probability", "timestamp")


def _batch_projection(spark, sf, spec, key):
    feats = ml.features_for(_LOADERS[spec.name](spark, sf, tags=True), spec, labelled=False)
    model = ml.train(feats.where(F.col(spec.label).isNotNull()).select("features", spec.label), spec.label, 42)
    scored = model.transform(feats.withColumn("record_id", F.col(key).cast("string")))
    return st.PROJECTIONS[spec.name](scored)


@register(
    "pr13_prediction_projection_transfers",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, nameOrig || '_' || CAST(step AS VARCHAR) AS transaction_id,
  nameOrig AS customer_id, CAST(amount AS REAL) AS amount,
  CAST(CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE 0.0 END AS REAL) AS amount_to_balance_ratio, true AS scores_ok FROM transfers""",
)
def pr13(spark, sf):
    """PR-13 on a batch of dataset 1 (id = order key)."""
    return _projected(_batch_projection(spark, sf, TRANSFERS, "o_orderkey"))


@register(
    "pr15_prediction_projection_card_transactions",
    """SELECT transaction_id AS id, fraud = 1 AS fraud, customer_id, CAST(amt AS REAL) AS amount, true AS scores_ok
FROM card_transactions""",
)
def pr15(spark, sf):
    """PR-15 on a batch of dataset 3."""
    return _projected(_batch_projection(spark, sf, CARD_TRANSACTIONS, "transaction_id"))


@register("ext6_unified_customer_view")
def ext6(spark, sf):
    """Batch customer risk joined with aggregates of dataset-3 predictions."""
    from ..operators import extensions, views

    preds = _batch_projection(spark, sf, CARD_TRANSACTIONS, "transaction_id")
    risk = views.customer_risk(adapters.card_transactions(spark, sf))
    return extensions.unified_customer_view(risk, preds)


def _sink_contents(spark, sf, spec, cols):
    """Deterministic columns of a scoring sink, plus a flag that the model's
    probability is a probability (the id, processing time and the model's
    choices are not reproducible outside Spark)."""
    out = _score_stream(spark, sf, spec)
    ok = F.col("fraud_probability").between(0.0, 1.0)
    return out.select(*cols, ok.alias("probability_ok"))


@register(
    "st1_sink_contents_transfers",
    """SELECT nameOrig || '_' || CAST(step AS VARCHAR) AS transaction_id, nameOrig AS customer_id,
  CAST(amount AS REAL) AS amount,
  CAST(CASE WHEN oldbalanceOrg > 0
    THEN CAST(CAST(amount AS REAL) AS DOUBLE) / CAST(CAST(oldbalanceOrg AS REAL) AS DOUBLE) ELSE 0 END AS REAL)
    AS amount_to_balance_ratio,
  true AS probability_ok FROM transfers""",
)
def st1c(spark, sf):
    return _sink_contents(spark, sf, TRANSFERS, ["transaction_id", "customer_id", "amount", "amount_to_balance_ratio"])


CB_SINK = ", ".join(
    [f"CAST({c} AS REAL) AS {c}" for c in ("distance_from_home", "distance_from_last_transaction",
                                            "ratio_to_median_purchase_price")]
    + [f"CAST({c} AS INT) AS {c}" for c in ("repeat_retailer", "used_chip", "used_pin_number", "online_order")]
)


@register("st2_sink_contents_card_behaviour", f"SELECT {CB_SINK}, true AS probability_ok FROM card_behaviour")
def st2c(spark, sf):
    return _sink_contents(spark, sf, CARD_BEHAVIOUR, CARD_BEHAVIOUR.features)


@register(
    "st3_sink_contents_card_transactions",
    "SELECT fraud = 1 AS fraud, customer_id, CAST(amt AS REAL) AS amount, true AS probability_ok FROM card_transactions",
)
def st3c(spark, sf):
    return _sink_contents(spark, sf, CARD_TRANSACTIONS, ["fraud", "customer_id", "amount"])


@register(
    "pr14_prediction_projection_card_behaviour",
    f"SELECT CAST(l_orderkey AS VARCHAR) AS id, {CB_SINK}, true AS scores_ok FROM card_behaviour",
)
def pr14(spark, sf):
    """PR-14 on a batch of dataset 2."""
    return _projected(_batch_projection(spark, sf, CARD_BEHAVIOUR, "l_orderkey"))


@register(
    "snk2_keyed_upsert",
    """SELECT transaction_id, customer_id, CAST(CASE WHEN entry_mode = 'Swipe' THEN amt + 1 ELSE amt END AS REAL) AS amount
FROM card_transactions""",
)
def snk2_keyed(spark, sf):
    """SNK-2 with the primary key: dataset 3's records, then corrected ones of some of
    the same transactions, as two batches of one stream; a row a transaction is left, its last."""
    spec = CARD_TRANSACTIONS
    base = scratch_path(spark, "keyed-sink")
    src, out, ckpt = (os.path.join(base, d) for d in ("in", "table", "checkpoint"))
    df = adapters.card_transactions(spark, sf, tags=True)
    corrected = df.where("entry_mode = 'Swipe'").withColumn("amt", F.col("amt") + 1)
    for part, rows in (("first", df), ("second", corrected)):
        ingest.encode_json(rows, spec).write.text(os.path.join(src, part))
        good, _ = ingest.validate(ingest.decode(st.read_stream(spark, "files", os.path.join(src, "*")), spec), spec, scoring=True)
        rows = good.select("transaction_id", "customer_id", F.col("amt").alias("amount"))
        st.start_keyed_sink(rows, out, ckpt, "keyed-sink", ["transaction_id"], buckets=16, available_now=True).awaitTermination()
    return cells.read(spark, out)


@register(
    "snk2_compacted_days",
    """SELECT transaction_id AS id, customer_id, CAST(amt AS REAL) AS amount, substr(post_ts, 1, 10) AS date FROM card_transactions""",
)
def snk2_compacted(spark, sf):
    """SNK-2 by date: dataset 3's records in several micro-batches, their days compacted
    into one run; the table read back."""
    out = dated_sink(spark, sf, scratch_path(spark, "dated-sink"))
    dated.compact(spark, out, "9999-01-01")
    return dated.read(spark, out).select("id", "customer_id", "amount", "date")


def dated_sink(spark, sf, base):
    """A sink of dataset 3 with the event's own time, written by a stream of a few files
    a micro-batch; returns its path."""
    spec = CARD_TRANSACTIONS
    src, out = os.path.join(base, "in"), os.path.join(base, "table")
    ingest.encode_json(adapters.card_transactions(spark, sf, tags=True).repartition(8), spec).write.text(src)
    good, _ = ingest.validate(ingest.decode(st.read_stream(spark, "files", src, max_files_per_trigger=3), spec), spec, scoring=True)
    rows = good.select(
        F.col("transaction_id").alias("id"),
        (F.col("fraud") == 1).alias("fraud"),
        "customer_id",
        F.col("amt").alias("amount"),
        F.to_timestamp_ntz("post_ts").alias("timestamp"),
    )
    st.start_dated_sink(rows, out, os.path.join(base, "checkpoint"), "dated-sink", available_now=True).awaitTermination()
    return out
