"""Structured Streaming: sources (SRC-1), scoring queries (ST-1..3, ST-5,
ST-6, ST-8), prediction projections (PR-13..15), the arrival-minute join
(ST-4 with JOIN-1 / JOIN-2) and running them together (ST-7).

Each scoring query is one streaming plan: decode -> validate -> prepare ->
assemble -> model -> projection -> date-partitioned Parquet runs. A run is
published once for each micro-batch, so a retried batch never leaves
duplicate rows (Q24), and the checkpoint makes a restart resume where it
stopped (ST-6).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import prob_class1, vec_item
from ..operators import ingest
from ..operators.ml import assemble, prepare
from ..sinks import cells, dated, fs
from ..specs import ARRIVAL_TAGS, CARD_BEHAVIOUR, CARD_TRANSACTIONS, TRANSFERS, DatasetSpec

DEFAULT_TRIGGER = "30 seconds"


def read_stream(
    spark: SparkSession,
    kind: str = "files",
    path: str | None = None,
    topic: str | None = None,
    servers: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """SRC-1: a stream of JSON records in a ``value`` column plus ``record_id``.

    ``kind="kafka"`` subscribes one topic (latest offsets, no failure on data
    loss, as the reference); the record id is then the source position, so a
    replay reproduces it. ``kind="files"`` reads new text files from ``path``.
    """
    if kind == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "latest")
            .option("failOnDataLoss", "false")
            .load()
        )
        return raw.select(
            F.col("value").cast("string").alias("value"),
            F.concat_ws(":", "topic", "partition", "offset").alias("record_id"),
        )
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).select("value", F.expr("uuid()").alias("record_id"))


def _now():
    return F.current_timestamp().alias("timestamp")  # ST-8: per micro-batch


def project_transfers(scored: DataFrame) -> DataFrame:
    """PR-13."""
    return scored.select(
        F.col("record_id").alias("id"),
        "transaction_id",
        (F.col("prediction") > 0.5).alias("fraud"),
        F.col("prediction").cast("int").alias("prediction"),
        prob_class1("probability").cast("float").alias("fraud_probability"),
        F.col("nameOrig").alias("customer_id"),
        vec_item("features", 0).cast("float").alias("amount"),
        vec_item("features", 1).cast("float").alias("amount_to_balance_ratio"),
        _now(),
    )


def project_card_behaviour(scored: DataFrame) -> DataFrame:
    """PR-14: the four flags go to INT columns."""
    names = CARD_BEHAVIOUR.features
    return scored.select(
        F.col("record_id").alias("id"),
        (F.col("prediction") > 0.5).alias("fraud"),
        F.col("prediction").cast("int").alias("prediction"),
        prob_class1("probability").cast("float").alias("fraud_probability"),
        *[vec_item("features", i).cast("float" if i < 3 else "int").alias(n) for i, n in enumerate(names)],
        _now(),
    )


def project_card_transactions(scored: DataFrame) -> DataFrame:
    """PR-15: ``fraud`` is the input label, as in the reference (Q8)."""
    return scored.select(
        F.col("record_id").alias("id"),
        (F.col("fraud") == 1).alias("fraud"),
        "customer_id",
        prob_class1("probability").cast("float").alias("fraud_probability"),
        vec_item("features", 0).cast("float").alias("amount"),
        _now(),
    )


PROJECTIONS = {
    TRANSFERS.name: project_transfers,
    CARD_BEHAVIOUR.name: project_card_behaviour,
    CARD_TRANSACTIONS.name: project_card_transactions,
}


def scored_stream(records: DataFrame, model: PipelineModel, spec: DatasetSpec) -> DataFrame:
    """The scoring plan without a sink: records with all features and ids
    (others would stop the query at the assembler, Q7). A label isn't needed:
    what is to be scored mostly has none yet."""
    decoded = ingest.decode(records, spec)
    good, _ = ingest.validate(decoded, spec, scoring=True)
    feats = assemble(prepare(good, spec), spec.features)
    return PROJECTIONS[spec.name](model.transform(feats))


def quarantine_stream(records: DataFrame, spec: DatasetSpec) -> DataFrame:
    decoded = ingest.decode(records, spec, fields=spec.required_for_scoring)
    _, bad = ingest.validate(decoded, spec, scoring=True)
    return bad.select("record_id", "_raw", "reason", _now())


def start_sink(
    df: DataFrame,
    out: str,
    checkpoint: str,
    name: str,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """Append to one Parquet folder by Spark's file sink, own checkpoint, named query."""
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start(out)


_FIRST = "_first-batch-"


def _first_batch(spark: SparkSession, checkpoint: str, held: int) -> int:
    """The table's number for batch 0 of this checkpoint, kept beside it. A new
    checkpoint counts from 0 again; on a table that holds batches up to ``held`` its own
    come after them, or they would be taken for replays."""
    kept = [f for f in fs.list_files(spark, checkpoint) if f.startswith(_FIRST)]
    if not kept:
        kept = [f"{_FIRST}{held + 1}"]
        fs.create_marker(spark, os.path.join(checkpoint, kept[0]))
    return int(kept[0][len(_FIRST) :])


def _each_batch(df, write, checkpoint, name, trigger, available_now) -> StreamingQuery:
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).queryName(name).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def start_dated_sink(
    df: DataFrame,
    out: str,
    checkpoint: str,
    name: str,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
    ts_col: str = "timestamp",
) -> StreamingQuery:
    """SNK-2 with ST-5/ST-6: append under the dates of ``ts_col``, a published run for
    each micro-batch; ``sinks.dated`` reads, compacts and expires the runs."""
    held = dated.runs(df.sparkSession, out)
    first = _first_batch(df.sparkSession, checkpoint, held[-1][1] if held else -1)
    return _each_batch(df, lambda batch, n: dated.append(batch, out, first + n, ts_col), checkpoint, name, trigger, available_now)


def start_dated_sinks(
    df: DataFrame,
    tables: Mapping[str, Callable[[DataFrame], DataFrame]],
    checkpoint: str,
    name: str,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
    ts_col: str = "timestamp",
) -> StreamingQuery:
    """``start_dated_sink`` into several tables: path -> its rows of a micro-batch, which
    is computed once and kept while they are written. A batch that stopped between two
    tables is replayed, and the one that has it writes nothing."""
    spark, first = df.sparkSession, {}
    for out in tables:
        held = dated.runs(spark, out)
        first[out] = _first_batch(spark, os.path.join(checkpoint, "_tables", os.path.basename(out)), held[-1][1] if held else -1)

    def write(batch: DataFrame, n: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for out, rows in tables.items():
                dated.append(rows(batch), out, first[out] + n, ts_col)
        finally:
            batch.unpersist()

    return _each_batch(df, write, checkpoint, name, trigger, available_now)


def start_keyed_sink(
    df: DataFrame,
    out: str,
    checkpoint: str,
    name: str,
    key: Sequence[str],
    order: str | None = None,
    buckets: int = 64,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """SNK-2 with a primary key: the last row written for each ``key`` (``sinks.cells``)."""
    first = _first_batch(df.sparkSession, checkpoint, cells.last_batch(df.sparkSession, out))
    return _each_batch(df, lambda batch, n: cells.upsert(batch, out, key, first + n, order, buckets), checkpoint, name, trigger, available_now)


def score(
    records: DataFrame,
    model: PipelineModel,
    spec: DatasetSpec,
    out: str,
    checkpoint: str,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """ST-1..3: start the scoring query for one dataset."""
    return start_dated_sink(
        scored_stream(records, model, spec), out, checkpoint, f"score-{spec.name}", trigger, available_now
    )


# ---- ST-4: the arrival-minute join --------------------------------------------

MINUTE_KEY = ["hour", "minute"]


def _key_ok():
    """Hour and minute as on a clock; the as-written key has at most 1,440 values."""
    hour, minute = F.col("hour").try_cast("int"), F.col("minute").try_cast("int")
    return F.coalesce(hour.between(0, 23) & minute.between(0, 59), F.lit(False))


def _decoded_keys(records: DataFrame, spec: DatasetSpec, bounded: bool, watermark: str, *fields: str) -> DataFrame:
    """Records that have a join key, decoded as far as it and ``fields`` go; ``arrival``
    behind its own watermark."""
    from ..operators.joins import arrival_minute

    d = ingest.decode(records, spec, keep_raw=False, fields=[*ARRIVAL_TAGS, *fields]).where(_key_ok())
    if not bounded:
        return d
    return d.withColumn("arrival", arrival_minute()).where(F.col("arrival").isNotNull()).withWatermark("arrival", watermark)


def join_quarantine_stream(records: DataFrame, spec: DatasetSpec, bounded: bool = True) -> DataFrame:
    """Records that can't take part in the join, with the reason."""
    from ..operators.joins import arrival_minute

    ok = _key_ok() & arrival_minute().isNotNull() if bounded else _key_ok()
    bad = ingest.decode(records, spec, fields=ARRIVAL_TAGS).where(~ok)
    return bad.select("record_id", "_raw", F.lit("invalid:arrival").alias("reason"), _now())


def join_counts_stream(
    streams: Sequence[tuple[DataFrame, DatasetSpec]], bounded: bool = True, watermark: str = "10 minutes"
) -> DataFrame:
    """Per key, the rows of each of the three streams and the joined size.

    ``bounded=False`` is the join as written (key = hour, minute; no date):
    state has one row per key, at most 1,440, but counts never close, so the
    result is a running total (update / complete mode).
    ``bounded=True`` keys on the full arrival minute behind a watermark: each
    minute is emitted once, when it can no longer change, and its state is
    dropped (append mode).

    Each stream has its own watermark, set before the union, and the lowest one
    holds (Spark's default policy): a stream that lags is waited for, and an idle
    one holds all minutes open until it sends again. Records without a valid key
    take no part, and only keys that all three streams have are given out.
    """
    keys = ["arrival"] if bounded else MINUTE_KEY
    sides = [
        _decoded_keys(r, s, bounded, watermark).select(*keys, F.lit(f"n{i + 1}").alias("side")) for i, (r, s) in enumerate(streams)
    ]
    u = sides[0]
    for s in sides[1:]:
        u = u.unionByName(s)
    agg = [F.count_if(F.col("side") == f"n{i}").alias(f"n{i}") for i in (1, 2, 3)]
    out = u.groupBy(*keys).agg(*agg)
    return out.withColumn("n_joined", F.col("n1") * F.col("n2") * F.col("n3")).where("n_joined > 0")


def join_rows_stream(streams: Sequence[tuple[DataFrame, DatasetSpec]], watermark: str = "10 minutes", counts: bool = False) -> DataFrame:
    """ST-4's rows: each dataset-3 record in the bounded join once, as ``id,
    transaction_id, customer_id, arrival, n_joined``; ``n_joined`` is the number of
    joined rows that it stands in (partners of the other two streams in its minute).

    Rows wait in state until their minute closes, then leave with its counts; with
    ``counts`` these (``n1, n2, n3``) are in each row, too.
    """
    closed = join_counts_stream(streams, True, watermark).select(
        F.col("arrival").alias("minute_closed"), (F.col("n1") * F.col("n2")).alias("n_joined"), *["n1", "n2", "n3"] * counts
    )
    records, spec = streams[2]
    own = ["transaction_id", "customer_id"]
    rows = _decoded_keys(records, spec, True, watermark, *own).select(F.col("record_id").alias("id"), *own, "arrival")
    return rows.join(closed, F.col("arrival") == F.col("minute_closed")).drop("minute_closed")


def counts_of(rows: DataFrame) -> DataFrame:
    """``join_counts_stream``'s minutes from a batch of ``join_rows_stream``'s rows with counts.
    None is missed: a joined minute has dataset-3 records, and all leave when it closes."""
    n = [F.first(c).alias(c) for c in ("n1", "n2", "n3")]
    return rows.groupBy("arrival").agg(*n).withColumn("n_joined", F.col("n1") * F.col("n2") * F.col("n3"))


def run_all(spark: SparkSession, queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """ST-7: wait until any query ends (or the timeout), then stop every active
    query, including ones started elsewhere in the session."""
    try:
        if timeout is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(timeout)
    finally:
        for q in list(spark.streams.active):
            q.stop()
        for q in queries:
            if q.isActive:
                q.stop()
