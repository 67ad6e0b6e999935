"""The four aggregate views of the batch layer and their refresh job.

Each view is one ``groupBy().agg()`` of algebraic aggregates, so Spark plans a
partial hash aggregate before the shuffle: a key holding a third of all rows
is reduced to one row per map task before it is exchanged.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import amount_bucket, hour_of, is_fraud
from ..session import ensure_checkpoint_dir
from ..sinks import cells
from ..sinks.views import replace_view

log = logging.getLogger(__name__)


def _measures(label: str, amount: str, fraud_name: str, amount_agg: str = "avg"):
    agg = F.avg(amount).alias("avg_amount") if amount_agg == "avg" else F.sum(amount).alias("total_amount")
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(is_fraud(label)).cast("long").alias(fraud_name),
        agg,
    ]


def fraud_by_type(df: DataFrame) -> DataFrame:
    """AGG-1: type -> total, fraudulent, average amount, fraud rate."""
    return (
        df.groupBy("type")
        .agg(*_measures("isFraud", "amount", "total_fraudulent"))
        .withColumn("fraud_rate", F.col("total_fraudulent") / F.col("total_transactions"))
    )


def fraud_by_amount(df: DataFrame) -> DataFrame:
    """AGG-2: amount bucket -> same measures."""
    return (
        df.groupBy(amount_bucket("amount").alias("amount_bucket"))
        .agg(*_measures("isFraud", "amount", "total_fraudulent"))
        .withColumn("fraud_rate", F.col("total_fraudulent") / F.col("total_transactions"))
    )


def hourly(df: DataFrame, with_rate: bool = False) -> DataFrame:
    """AGG-3: hour of post_ts -> total, fraudulent, average amt (no rate, Q14)."""
    out = df.groupBy(hour_of("post_ts").alias("hour")).agg(
        *_measures("fraud", "amt", "total_fraudulent")
    )
    if with_rate:
        out = out.withColumn("fraud_rate", F.col("total_fraudulent") / F.col("total_transactions"))
    return out


def customer_risk(df: DataFrame) -> DataFrame:
    """AGG-4: customer -> total, fraudulent, total amount, rate (all customers, Q13)."""
    return (
        df.groupBy("customer_id")
        .agg(*_measures("fraud", "amt", "fraudulent_transactions", amount_agg="sum"))
        .withColumn(
            "fraud_rate", F.col("fraudulent_transactions") / F.col("total_transactions")
        )
    )


# view name -> (source dataset, builder, published columns in order)
VIEWS: dict[str, tuple[str, Callable[[DataFrame], DataFrame], tuple[str, ...]]] = {
    "fraud_by_transaction_type": (
        "dataset1", fraud_by_type,
        ("type", "total_transactions", "total_fraudulent", "avg_amount", "fraud_rate"),
    ),
    "fraud_by_amount_bucket": (
        "dataset1", fraud_by_amount,
        ("amount_bucket", "total_transactions", "total_fraudulent", "avg_amount", "fraud_rate"),
    ),
    "hourly_fraud_stats": (
        "dataset3", hourly,
        ("hour", "total_transactions", "total_fraudulent", "avg_amount"),
    ),
    "high_risk_customers": (
        "dataset3", customer_risk,
        ("customer_id", "total_transactions", "fraudulent_transactions", "total_amount", "fraud_rate"),
    ),
}


def _grain(df: DataFrame, src: str, by: tuple[Column, ...] = ()) -> DataFrame:
    """Finest grain all views of one source roll up from, in a single scan (for each
    value of ``by``).

    dataset1: (type, amount bucket), at most a few dozen rows in total.
    dataset3: (customer, hour), bounded by customers x 24.
    Sums and non-NULL counts are kept so averages roll up exactly like ``avg``.
    """
    if src == "dataset1":
        keys = [F.col("type"), amount_bucket("amount").alias("amount_bucket")]
        label, amount = "isFraud", "amount"
    else:
        keys = [F.col("customer_id"), hour_of("post_ts").alias("hour")]
        label, amount = "fraud", "amt"
    return df.groupBy(*by, *keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(is_fraud(label)).cast("long").alias("_f"),
        F.sum(amount).alias("_s"),
        F.count(amount).alias("_c"),
    )


def _roll(grain: DataFrame, key: str, fraud_name: str, amount: str, rate: bool) -> DataFrame:
    agg = [
        F.sum("_n").alias("total_transactions"),
        F.sum("_f").alias(fraud_name),
    ]
    if amount == "avg_amount":
        agg.append((F.sum("_s") / F.sum("_c")).alias("avg_amount"))
    else:
        agg.append(F.sum("_s").alias("total_amount"))
    out = grain.groupBy(key).agg(*agg)
    if rate:
        out = out.withColumn("fraud_rate", F.col(fraud_name) / F.col("total_transactions"))
    return out


# Views of unbounded size: their versions are clustered by this key for lookups (SV-2).
CLUSTERED = {"high_risk_customers": "customer_id"}

_ROLLUPS = {
    "fraud_by_transaction_type": ("type", "total_fraudulent", "avg_amount", True),
    "fraud_by_amount_bucket": ("amount_bucket", "total_fraudulent", "avg_amount", True),
    "hourly_fraud_stats": ("hour", "total_fraudulent", "avg_amount", False),
    "high_risk_customers": ("customer_id", "fraudulent_transactions", "total_amount", True),
}


def _publish(grain: DataFrame, names: Sequence[str], out: str) -> dict[str, str]:
    done = {}
    for view in names:
        key, fraud_name, amount, rate = _ROLLUPS[view]
        rolled = _roll(grain, key, fraud_name, amount, rate).select(*VIEWS[view][2])
        done[view] = replace_view(grain.sparkSession, rolled, out, view, key=CLUSTERED.get(view))
    return done


def refresh(
    spark: SparkSession,
    sources: dict[str, DataFrame | Callable[[], DataFrame | None] | None],
    out: str,
    parallel: bool = True,
) -> dict[str, str]:
    """AGG-5: rebuild every view from its source and publish it atomically.

    ``sources`` maps a dataset name to a DataFrame, a loader returning one, or
    None. A missing source skips its views (the others still run, Q26); any
    other failure is raised. Each source is scanned once: it is aggregated to
    the shared grain, which is checkpointed (small, and lineage-free so a lost
    executor does not re-scan the source), and every view rolls up from it.
    The sources are independent, so their jobs are submitted concurrently and
    the scheduler runs them side by side. Returns view name -> published path.
    """
    by_source: dict[str, list[str]] = {}
    for view, (src, _, _) in VIEWS.items():
        by_source.setdefault(src, []).append(view)

    def one_source(src: str, views: list[str]) -> dict[str, str]:
        loader = sources.get(src)
        df = loader() if callable(loader) else loader
        if df is None:
            log.warning("source %s missing; skipping %s", src, ", ".join(views))
            return {}
        return _publish(_grain(df, src).checkpoint(eager=True), views, out)

    ensure_checkpoint_dir(spark)
    published: dict[str, str] = {}
    if parallel and len(by_source) > 1:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=len(by_source)) as pool:
            futures = [pool.submit(one_source, src, v) for src, v in by_source.items()]
            for f in futures:
                published.update(f.result())
    else:
        for src, v in by_source.items():
            published.update(one_source(src, v))
    return published


DAY = "_day"


def day_of() -> Column:
    """The day of a date-partitioned row as text; rows without one share a day."""
    return F.coalesce(F.concat_ws("-", *(F.col(c) for c in ("year", "month", "day"))), F.lit(""))


def changed_days(df: DataFrame, since) -> list[str]:
    """Days of a date-partitioned file table with files written after ``since`` (a
    timestamp or its text); other files are left out by their modification time."""
    recent = df.where(F.col("_metadata.file_modification_time") > F.lit(since).cast("timestamp"))
    return sorted(r[0] for r in recent.select(day_of()).distinct().collect())


def refresh_days(
    spark: SparkSession,
    sources: dict[str, DataFrame | Callable[[], DataFrame | None] | None],
    out: str,
    days: Sequence[str] | None = None,
) -> dict[str, str]:
    """AGG-5 by date range: bring the views up to date where only some ``days``
    ("YYYY-MM-DD") of the date-partitioned sources changed; all days when None.

    The grain is kept for each day under ``out``/_grain (a cell table): only the
    changed days are read from the source (partition pruning) and aggregated, their
    cells replaced, and every view rolls up from the grains of all days, which merge since
    they are sums and counts. A day without rows any more is emptied. A missing
    source skips its views. Returns view name -> published path.
    """
    published: dict[str, str] = {}
    for src in dict.fromkeys(s for s, _, _ in VIEWS.values()):
        loader = sources.get(src)
        df = loader() if callable(loader) else loader
        if df is None:
            log.warning("source %s missing; its views are left as they are", src)
            continue
        base = os.path.join(out.rstrip("/"), "_grain", src)
        held = cells.manifest(spark, base)
        if days is None:
            now = {r[0] for r in df.select(day_of()).distinct().collect()}  # a row a day
            before = set() if held is None else {r["cell"][1:] for r in held.select("cell").collect()}
            changed = sorted(now | before)
        else:
            changed = sorted(set(days))
            df = df.where(day_of().isin(changed))
        # "d" keeps the cell of rows without a day from being empty text.
        grain = _grain(df, src, (F.concat(F.lit("d"), day_of()).alias(DAY),))
        cells.replace(grain, base, DAY, [f"d{d}" for d in changed])
        published |= _publish(cells.read(spark, base), [v for v, (s, _, _) in VIEWS.items() if s == src], out)
    return published
