"""Ingest shaping: decode (SRC-2), validation with quarantine (V-1), date tags
(V-2) and schema conformance (V-3). All are projections and filters, so they
run inside one whole-stage-codegen span per partition with no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import ARRIVAL_TAGS, DatasetSpec

QUALITY_COL = "quality"
VALID, QUARANTINE = "valid", "quarantine"


def encode_json(df: DataFrame, spec: DatasetSpec, out: str = "value") -> DataFrame:
    """Render rows as the JSON records a stream carries (tags + table columns)."""
    cols = [c for c in ARRIVAL_TAGS if c in df.columns] + [n for n, _ in spec.columns if n in df.columns]
    return df.select(F.to_json(F.struct(*cols)).alias(out))


def decode(df: DataFrame, spec: DatasetSpec, value_col: str = "value", keep_raw: bool = True, fields: Sequence[str] | None = None) -> DataFrame:
    """SRC-2: parse one JSON object per record with the fixed stream schema, or only
    ``fields`` of it (the others are read over, not converted; they never change these).

    PERMISSIVE: malformed text gives all-NULL fields, a wrongly typed field is
    NULL on its own (Q6). The raw text is kept as ``_raw`` for the quarantine.
    """
    schema = spec.stream_schema
    if fields is not None:
        schema = T.StructType([f for f in schema if f.name in fields])
    parsed = F.from_json(F.col(value_col).cast("string"), schema, {"mode": "PERMISSIVE"})
    passthrough = [c for c in df.columns if c != value_col]
    raw = [F.col(value_col).cast("string").alias("_raw")] if keep_raw else []
    # ``inline`` of a one-element array flattens the parsed struct in a
    # Generate. Filters on the parsed fields (validation) cannot be pushed
    # below a Generate, so the JSON is parsed once per record. A plain
    # ``select("p.*")`` lets the optimizer substitute ``from_json`` into every
    # pushed-down null check, which parses each record once per check.
    return df.select(*passthrough, *raw, F.inline(F.array(parsed)))


def reason(spec: DatasetSpec, df: DataFrame, scoring: bool = False) -> Column:
    """Comma-separated list of failed checks; NULL when the record is valid.
    ``scoring`` asks for features and ids only, not for the label."""
    required = spec.required_for_scoring if scoring else spec.required
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in required if c in df.columns]
    joined = F.concat_ws(",", *checks)
    return F.when(joined == "", F.lit(None).cast("string")).otherwise(joined)


def validate(df: DataFrame, spec: DatasetSpec, scoring: bool = False) -> tuple[DataFrame, DataFrame]:
    """V-1: split into (valid, quarantined-with-reason). Valid + quarantined = input."""
    marked = df.withColumn("_reason", reason(spec, df, scoring))
    good = marked.where(F.col("_reason").isNull()).drop("_reason")
    bad = marked.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return good, bad


def mark(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """V-1 in one column: ``quality`` = valid | quarantine, plus ``reason``.

    Landing writes both outcomes in one job, partitioned by ``quality``, so the
    input is scanned once instead of once per outcome.
    """
    r = reason(spec, df)
    return df.withColumn("reason", r).withColumn(
        QUALITY_COL, F.when(F.col("reason").isNull(), F.lit(VALID)).otherwise(F.lit(QUARANTINE))
    )


def tag(df: DataFrame, ts_col: str | Column, minutes: bool = True) -> DataFrame:
    """V-2: year, month, day (and hour, minute) string tags from a timestamp."""
    ts = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    out = df.withColumns(
        {
            "year": F.lpad(F.year(ts).cast("string"), 4, "0"),
            "month": F.lpad(F.month(ts).cast("string"), 2, "0"),
            "day": F.lpad(F.dayofmonth(ts).cast("string"), 2, "0"),
        }
    )
    if minutes:
        out = out.withColumns({"hour": F.hour(ts).cast("string"), "minute": F.minute(ts).cast("string")})
    return out


def conform(df: DataFrame, spec: DatasetSpec, keep_extra: bool = True) -> DataFrame:
    """V-3: coerce every spec field to its type; text that does not fit is NULL."""
    names = {n for n, _ in spec.columns}
    typed = [
        (F.col(n).try_cast(t) if n in df.columns else F.lit(None).cast(t)).alias(n)
        for n, t in spec.columns
    ]
    extra = [F.col(c) for c in df.columns if c not in names] if keep_extra else []
    return df.select(*extra, *typed)
