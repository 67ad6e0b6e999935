"""Serving: SQL over the published views and predictions (SV-1), key lookups
(SV-2) and the flagged-transactions list (SV-3 with LIM-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import dated
from ..sinks.views import read_view

SERVING_ROW_LIMIT = 5000


def register_views(spark: SparkSession, out: str, names) -> list[str]:
    """SV-1: expose each published view as a temp view of the same name."""
    done = []
    for n in names:
        df = read_view(spark, out, n)
        if df is not None:
            df.createOrReplaceTempView(n)
            done.append(n)
    return done


def register_tables(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> list[str]:
    """SV-1: expose sink outputs (prediction tables) as temp views by name."""
    for name, path in paths.items():
        spark.read.format(fmt).load(path).createOrReplaceTempView(name)
    return list(paths)


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """SV-2 over any frame: rows with ``key == value`` (pushed down to the Parquet scan).
    ``sinks.views.lookup_view`` also leaves out files, ``sinks.cells.lookup`` buckets."""
    return df.where(F.col(key) == F.lit(value))


def flagged(df: DataFrame, ts_col: str = "timestamp", id_col: str = "id", limit: int = SERVING_ROW_LIMIT) -> DataFrame:
    """SV-3 over any frame: flagged rows, newest first, capped at the serving row limit.
    The id breaks ties so the cut is deterministic; Spark plans this as a
    top-k (TakeOrderedAndProject), not a full sort."""
    return df.where(F.col("fraud")).orderBy(F.desc(ts_col), F.asc(id_col)).limit(limit)


def flagged_newest(spark: SparkSession, base: str, limit: int = SERVING_ROW_LIMIT, ts_col: str = "timestamp", id_col: str = "id") -> DataFrame | None:
    """SV-3 over a prediction sink (``sinks.dated``): the same list, from as few of its
    dates as hold it, newest first."""
    return dated.newest(spark, base, F.col("fraud"), limit, ts_col, id_col)
