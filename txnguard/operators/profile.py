"""Dataset profiling (AGG-6..12), filters (FL-1..4) and previews (LIM-1).

Totals that a share needs come from aggregates of one row, or one row per
column, read as literals or joined back; never from a global window that would
funnel every row through one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exact_quantiles, is_fraud


def is_missing(df: DataFrame, col: str):
    """One rule for the whole profile: NULL, and NaN in floating columns."""
    c = F.col(f"`{col}`")
    floating = isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType))
    return c.isNull() | F.isnan(c) if floating else c.isNull()


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-6: per column, each value's count and share of the non-missing rows,
    count-descending. All columns are counted in one scan and one shuffle: rows
    are unpivoted to (column, value) and partially aggregated map-side."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.when(~is_missing(df, c), F.col(c).cast("string")).alias("value")) for c in cols])
    )
    counts = (
        df.select(pairs.alias("p"))
        .select("p.column", "p.value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    totals = counts.groupBy("column").agg(F.sum("count").alias("_total"))
    return (
        counts.join(F.broadcast(totals), "column")
        .select("column", "value", "count", (F.col("count") / F.col("_total")).alias("share"))
        .orderBy("column", F.desc("count"), "value")
    )


def step_frequency(df: DataFrame, col: str = "step") -> DataFrame:
    """AGG-7 with ORD-1: rows per step, ordered by step."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(col)


def missing(df: DataFrame) -> DataFrame:
    """AGG-8: missing values per column (NULL, or NaN for floating columns),
    one aggregate pass, then unpivoted to one row per column."""
    exprs = [F.sum(F.when(is_missing(df, c), 1).otherwise(0)).cast("long").alias(c) for c in df.columns]
    one = df.agg(*exprs)
    stacked = F.explode(
        F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("missing")) for f in df.schema.fields])
    )
    return one.select(stacked.alias("s")).select("s.column", "s.missing")


def describe(df: DataFrame, col: str) -> DataFrame:
    """AGG-9: count, mean, sample std, min, quartiles (linear), max, one row."""
    kept = df.where(~is_missing(df, col))
    qs = exact_quantiles(kept, col, [0.25, 0.5, 0.75]).first()
    stats = kept.agg(
        F.count(col).alias("count"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.min(col).cast("double").alias("min"),
        F.max(col).cast("double").alias("max"),
    )
    quartiles = [F.lit(q).cast("double").alias(n) for q, n in zip(qs, ("p25", "p50", "p75"))]
    return stats.select("count", "mean", "std", "min", *quartiles, "max")


def row_count(df: DataFrame) -> DataFrame:
    """AGG-10."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def fraud_share(datasets: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """AGG-11 with SET-1: one row per dataset (name, rows, frauds, fraud_pct);
    each label is aligned to ``isFraud`` first, then the rows are unioned."""
    parts = [
        df.select(F.col(label).alias("isFraud"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("isFraud")).cast("long").alias("frauds"),
        )
        .select(F.lit(name).alias("dataset"), "rows", "frauds",
                (F.col("frauds") * 100.0 / F.col("rows")).alias("fraud_pct"))
        for name, df, label in datasets
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def zero_amount(df: DataFrame, col: str = "amount") -> DataFrame:
    """FL-1: transactions with amount exactly 0 (a pushed-down Parquet filter)."""
    return df.where(F.col(col) == 0)


def prefix_share(df: DataFrame, col: str = "nameDest", prefix: str = "M") -> DataFrame:
    """FL-2: rows whose ``col`` starts with ``prefix``: count and percentage (2 dp)."""
    return df.agg(
        F.count_if(F.col(col).startswith(prefix)).alias("matching"),
        F.count(F.lit(1)).alias("rows"),
    ).select("matching", "rows", F.round(F.col("matching") * 100.0 / F.col("rows"), 2).alias("pct"))


def fraud_rows(df: DataFrame, label: str = "isFraud") -> DataFrame:
    """FL-4: number of fraud rows and their percentage of all rows."""
    return df.agg(
        F.sum(is_fraud(label)).cast("long").alias("frauds"),
        F.count(F.lit(1)).alias("rows"),
    ).select("frauds", "rows", (F.col("frauds") * 100.0 / F.col("rows")).alias("fraud_pct"))


def iqr_bounds(df: DataFrame, col: str) -> DataFrame:
    """One row: q1, q3 and the 1.5 x IQR fences (exact, linear interpolation)."""
    q = exact_quantiles(df, col, [0.25, 0.75])
    return q.select(
        F.col("q0").alias("q1"),
        F.col("q1").alias("q3"),
        (F.col("q0") - 1.5 * (F.col("q1") - F.col("q0"))).alias("lower"),
        (F.col("q1") + 1.5 * (F.col("q1") - F.col("q0"))).alias("upper"),
    )


def remove_outliers(df: DataFrame, col: str) -> DataFrame:
    """FL-3: keep rows inside [q1 - 1.5 iqr, q3 + 1.5 iqr] and > 0.

    The fences are two scalars from a one-row aggregate over the distributed
    exact quartiles; no row moves across the network for the filter.
    """
    # The fences are one row of two numbers (what a scalar subquery would
    # fetch too); as literals the filter is a plain Filter that Parquet can
    # use for row-group pruning, and the quantile plan runs exactly once.
    fences = iqr_bounds(df, col).select("lower", "upper").first()
    c = F.col(col)
    if fences is None or fences["lower"] is None:
        return df.where(F.lit(False))
    return df.where((c >= F.lit(fences["lower"])) & (c <= F.lit(fences["upper"])) & (c > 0))


def density(df: DataFrame, col: str, grid: int = 200, bins_per_h: int = 20, cut: float = 3.0, reach: float = 8.0) -> DataFrame:
    """AGG-12: Gaussian kernel density of ``col`` on ``grid`` points.

    Scott's bandwidth h (sample std x n^-1/5), support extended by ``cut``
    bandwidths each side (the plotting defaults of the reference's notebook).
    Values are first binned linearly by a partial aggregate: centres are h /
    ``bins_per_h`` apart, and a value's weight goes to the two centres beside it, by
    nearness, so the error falls with the square of their distance however many rows
    there are. Then each centre meets the grid points within ``reach`` bandwidths,
    where all but 1e-15 of its kernel lies. Missing values (NULL, NaN) are left out. A
    column without spread (constant, a single row, none) has no density: no rows.
    """
    v = F.col(col).cast("double")
    data = df.where(~is_missing(df, col)).select(v.alias("_x"))
    n, sd, lo, hi = data.agg(F.count(F.lit(1)), F.stddev_samp("_x"), F.min("_x"), F.max("_x")).first()
    h = (sd or 0.0) * float(n) ** -0.2 if n else 0.0
    if not h > 0.0 or math.isinf(h):
        return df.sparkSession.createDataFrame([], "g int, x double, density double")
    width = h / bins_per_h
    at = (F.col("_x") - F.lit(lo)) / F.lit(width)
    bins = data.groupBy(F.floor(at).alias("b")).agg(F.count(F.lit(1)).alias("_n"), F.sum(at - F.floor(at)).alias("_right"))
    sides = F.array(F.struct(F.col("b").alias("b"), (F.col("_n") - F.col("_right")).alias("w")), F.struct((F.col("b") + 1).alias("b"), F.col("_right").alias("w")))
    centres = bins.select(F.inline(sides)).groupBy("b").agg(F.sum("w").alias("w"))
    start, stop = lo - cut * h, hi + cut * h
    step = (stop - start) / (grid - 1)
    centre = F.lit(lo) + F.col("b") * F.lit(width)
    first = F.greatest(F.ceil((centre - F.lit(reach * h + start)) / F.lit(step)), F.lit(0))
    last = F.least(F.floor((centre + F.lit(reach * h - start)) / F.lit(step)), F.lit(grid - 1))
    # A centre between two far grid points reaches none of them.
    near = centres.select(centre.alias("_c"), "w", F.explode(F.when(first <= last, F.sequence(first, last))).alias("g"))
    z = (F.lit(start) + F.col("g") * F.lit(step) - F.col("_c")) / F.lit(h)
    sums = near.groupBy("g").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("_s"))
    points = df.sparkSession.range(grid).select(F.col("id").alias("g")).join(sums, "g", "left")
    return points.select(
        F.col("g").cast("int").alias("g"),
        (F.lit(start) + F.col("g") * F.lit(step)).alias("x"),
        (F.coalesce("_s", F.lit(0.0)) / F.lit(n * h * math.sqrt(2 * math.pi))).alias("density"),
    )


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """LIM-1: the first ``n`` rows in a fixed order (a top-k, not a full sort)."""
    return df.orderBy(*order_by).limit(n)
