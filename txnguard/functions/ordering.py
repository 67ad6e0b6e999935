"""Global order statistics without a single-partition window.

A global ``row_number()`` or exact ``percentile`` puts every row (or every
distinct value) into one task. Here the input is first collapsed to one row per
distinct value (partial aggregation absorbs hot keys), range-partitioned, and
the running counts are stitched together from per-partition totals: only one
row per partition is ever gathered, and each task sees one range partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def weighted_prefix(
    df: DataFrame, value_col: str, weight_col: str, num_partitions: int | None = None
) -> DataFrame:
    """Add ``cum_before``: total weight of all rows with a smaller value.

    ``df`` must hold one row per distinct, non-NULL ``value_col``.
    """
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    n = _partitions(df, num_partitions)
    # Freeze the range assignment: the totals and the rows must see the same
    # partition ids, and a reliable checkpoint survives a lost executor.
    ranged = (
        df.repartitionByRange(n, value_col)
        .withColumn("_pid", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    totals = ranged.groupBy("_pid").agg(F.sum(weight_col).alias("_pt"))
    # One row per partition: this window is bounded by the partition count.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid", F.coalesce(F.sum("_pt").over(before), F.lit(0)).cast("long").alias("_off")
    )
    within = (
        Window.partitionBy("_pid")
        .orderBy(value_col)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(
            "cum_before",
            (F.col("_off") + F.coalesce(F.sum(weight_col).over(within), F.lit(0))).cast("long"),
        )
        .drop("_pid", "_off")
    )


def global_rank(df: DataFrame, col: str, out: str = "code") -> DataFrame:
    """Dense 0-based rank of each distinct non-NULL value of ``col``."""
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn("_w", F.lit(1))
    return weighted_prefix(distinct, col, "_w").select(col, F.col("cum_before").cast("int").alias(out))


ACCURACY = 10_000  # of the sketches: a rank is off by at most rows / ACCURACY
FEW = 10_000  # rows inside all brackets that are fetched to finish
PASSES = 12


def exact_quantiles(df: DataFrame, col: str | Column, probs: Sequence[float], name: str = "q") -> DataFrame:
    """Linear-interpolated quantiles (numpy 'linear', DuckDB quantile_cont).

    Returns one row with columns ``{name}0, {name}1, ...`` in ``probs`` order.
    NULLs and NaNs are ignored; an empty input gives NULLs.

    A sketch brackets the value at each target rank; a pass over the column counts
    rows below and inside each bracket, exactly, and sketches the inside anew. Each
    pass narrows a bracket by a factor of thousands, until the values inside are
    few (distinct values with counts) or all equal. Everything is a map-side
    aggregate: no row is shuffled, sorted or checkpointed. A bracket that misses
    its rank, should a sketch be off, is widened to the whole range.
    """
    c = F.col(col) if isinstance(col, str) else col
    spark = df.sparkSession
    v = F.col("_v")
    data = df.select(c.cast("double").alias("_v")).where(v.isNotNull() & ~F.isnan(v))
    near = sorted({min(1.0, max(0.0, p + d * 2.5 / ACCURACY)) for p in probs for d in (-1, 1)})
    n, least, most, at = data.agg(
        F.count(F.lit(1)), F.min("_v"), F.max("_v"), F.percentile_approx("_v", near, ACCURACY)
    ).first()
    schema = ", ".join(f"{name}{i} double" for i in range(len(probs)))
    if not n:
        return spark.createDataFrame([tuple(None for _ in probs)], schema)
    sketch = dict(zip(near, at))
    targets = {}  # rank -> bracket; the two ranks that a quantile lies between
    for p in probs:
        lo, hi = (sketch[min(1.0, max(0.0, p + d * 2.5 / ACCURACY))] for d in (-1, 1))
        for rank in {math.floor((n - 1) * p), min(math.floor((n - 1) * p) + 1, n - 1)}:
            targets[rank] = (least if p * ACCURACY < 5 else lo, most if (1 - p) * ACCURACY < 5 else hi)
    found: dict[int, float] = {}
    for _ in range(PASSES):
        open_ = {r: b for r, b in targets.items() if r not in found}
        brackets = sorted(set(open_.values()))
        if not brackets:
            break
        inside = [(v >= lo) & (v <= hi) for lo, hi in brackets]
        got = data.agg(
            *(F.count_if(v < lo) for lo, _ in brackets), *(F.count_if(x) for x in inside)
        ).first()
        below, held = dict(zip(brackets, got)), dict(zip(brackets, got[len(brackets) :]))
        for r, b in open_.items():
            if not below[b] <= r < below[b] + held[b]:
                targets[r] = (least, most)
            elif b[0] == b[1]:
                found[r] = b[0]
        open_ = {r: targets[r] for r in open_ if r not in found and targets[r] in held}
        few = sorted({b for b in open_.values() if held[b] <= FEW})
        if few:
            tagged = F.array_compact(F.array(*(F.when((v >= lo) & (v <= hi), F.lit(i)) for i, (lo, hi) in enumerate(few))))
            counts = data.select(F.explode(tagged).alias("b"), "_v").groupBy("b", "_v").agg(F.count(F.lit(1)).alias("w")).collect()
            for i, b in enumerate(few):
                upto = below[b]
                for value, w in sorted((x["_v"], x["w"]) for x in counts if x["b"] == i):
                    found.update({r: value for r, own in open_.items() if own == b and upto <= r < upto + w})
                    upto += w
        rest = {r: b for r, b in open_.items() if r not in found}
        if rest:
            def shares(r, b):
                return [min(1.0, max(0.0, (r - below[b]) / max(held[b] - 1, 1) + d * 2.5 / ACCURACY)) for d in (-1, 1)]

            got = data.agg(
                *(F.percentile_approx(F.when((v >= b[0]) & (v <= b[1]), v), shares(r, b), ACCURACY) for r, b in rest.items())
            ).first()
            for (r, b), (lo, hi) in zip(rest.items(), got):
                first, last = shares(r, b)
                targets[r] = (b[0] if first == 0 else lo, b[1] if last == 1 else hi)
    missing = [r for r in targets if r not in found]
    if missing:  # a distribution that no sketch narrows: count its distinct values
        counts = data.groupBy("_v").agg(F.count(F.lit(1)).alias("_w"))
        ranked = weighted_prefix(counts, "_v", "_w")
        for r in missing:
            found[r] = ranked.where((F.col("cum_before") <= r) & (r < F.col("cum_before") + F.col("_w"))).first()["_v"]

    def value(p: float) -> float:
        at = (n - 1) * p
        lo = math.floor(at)
        a, b = found[lo], found[min(lo + 1, n - 1)]
        return a if a == b else a + (b - a) * (at - lo)

    return spark.createDataFrame([tuple(value(p) for p in probs)], schema)
