"""File sinks: CSV with header (SNK-4), date-partitioned landing (SNK-5) and
ARFF text (the writer side of SRC-7, used to produce ARFF inputs)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ingest import QUALITY_COL


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """SNK-4: distributed CSV write with a header line in every part file."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def land(df: DataFrame, path: str, by_quality: bool = False, mode: str = "append") -> str:
    """SNK-5: Parquet partitioned by year/month/day (and by quality when the
    frame carries a validation mark, so valid and quarantined rows land in one
    job). Rows are clustered by the partition keys first, so each task writes
    few files instead of one per day it happens to see; the rebalance hint lets
    AQE split a day that holds a large share of the rows over several tasks."""
    parts = ([QUALITY_COL] if by_quality else []) + ["year", "month", "day"]
    (
        df.hint("rebalance", *parts)
        .write.mode(mode)
        .partitionBy(*parts)
        .parquet(path)
    )
    return path


def write_arff(df: DataFrame, path: str, relation: str) -> str:
    """Write ``df`` as ARFF: a header file plus distributed part files of rows."""
    spark = df.sparkSession
    header = [f"@relation {relation}"]
    for f in df.schema.fields:
        kind = "string" if f.dataType.simpleString() == "string" else "numeric"
        header.append(f"@attribute {f.name} {kind}")
    header.append("@data")
    spark.createDataFrame([(h,) for h in header], "value string").coalesce(1).write.text(
        os.path.join(path, "header")
    )
    line = F.concat_ws(
        ",", *[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in df.columns]
    )
    df.select(line.alias("value")).write.text(os.path.join(path, "rows"))
    return path
