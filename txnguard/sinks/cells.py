"""Copy-on-write tables of cells: SNK-2 with a primary key, and AGG-5 by day.

A table is a folder of data versions and a small published manifest that names, for
each cell (a hash bucket of the key, or a day), the version that holds it. A change
writes the touched cells anew, in one distributed write, and publishes the next
manifest with the marker protocol of ``sinks.views``: readers see a change whole or
not at all, untouched cells are neither read nor written, nothing is ever renamed or
overwritten, and a failed attempt leaves files that no manifest names.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fs
from .views import current_path, expire_versions, replace_view

MANIFEST = "manifest"
CELL = "_cell"
_SCHEMA = "cell string, path string, files long, state string"


def manifest(spark: SparkSession, base: str) -> DataFrame | None:
    """The current manifest (``cell, path, files, state``: a row a cell), or None."""
    path = current_path(spark, base, MANIFEST)
    return spark.read.schema(_SCHEMA).parquet(path) if path else None


def state(spark: SparkSession, base: str) -> str | None:
    """What the last change wrote beside its cells (a batch id, say)."""
    now = manifest(spark, base)
    row = now.select("state").first() if now is not None else None
    return row["state"] if row else None


def read(spark: SparkSession, base: str, cells: Sequence[str] | None = None) -> DataFrame | None:
    """The table, or only ``cells`` of it: other cells' files aren't even listed. None if
    nothing was published yet; without any of the cells, no rows."""
    now = manifest(spark, base)
    if now is None:
        return None
    every = now if cells is None else now.where(F.col("cell").isin([str(c) for c in cells]))
    # A row a cell: bounded by the table's buckets or days.
    paths = [os.path.join(base, r["path"]) for r in every.where("files > 0").select("path").collect()]
    schema = spark.read.parquet(os.path.join(base, "data", "schema")).schema
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def replace(df: DataFrame, base: str, cell: str, cells: Sequence[str], state: str = "") -> list[str]:
    """Put the rows of ``df`` in the place of ``cells``; returns these. ``cell`` (a string
    column) says which cell a row belongs to; a cell without rows is emptied. ``df`` may
    read the table itself: what it reads stays."""
    spark = df.sparkSession
    now = manifest(spark, base)
    rows = df.drop(cell)
    shape = os.path.join(base, "data", "schema")
    if not fs.exists(spark, os.path.join(shape, "_SUCCESS")):  # fixed with the first change
        rows.limit(0).write.mode("overwrite").parquet(shape)
    version = os.path.join("data", f"v{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}")
    target = os.path.join(base, version)
    # AQE splits a large cell over several writers and files.
    df.withColumnRenamed(cell, CELL).hint("rebalance", CELL).write.mode("errorifexists").partitionBy(CELL).parquet(target)
    written = {d.split("=", 1)[1] for d in fs.list_dirs(spark, target) if d.startswith(CELL + "=")}
    fresh = [(c, os.path.join(version, f"{CELL}={c}"), int(c in written), state) for c in map(str, cells)]
    stray = written - set(map(str, cells))
    if stray:
        raise ValueError(f"rows outside the cells to replace: {sorted(stray)[:5]}")
    table = spark.createDataFrame(fresh, _SCHEMA)
    if now is not None:
        kept = now.where(~F.col("cell").isin([str(c) for c in cells])).withColumn("state", F.lit(state))
        table = kept.unionByName(table)
    replace_view(spark, table.coalesce(1), base, MANIFEST)
    return [c for c, *_ in fresh]


def bucket(key: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("string")


def last_batch(spark: SparkSession, base: str) -> int:
    """The last batch that ``upsert`` published; -1 if none."""
    now = state(spark, base)
    return int(now.split("/")[0]) if now else -1


def upsert(batch: DataFrame, base: str, key: Sequence[str], batch_id: int, order: str | None = None, buckets: int = 64) -> bool:
    """SNK-2 as the reference's sinks store it: one row a primary key, the last one
    written. Rows of ``batch`` replace those of the same key; of several in one batch
    the one of greatest ``order`` stays (the greatest row if there is none).

    Idempotent by ``batch_id``, which rises from batch to batch of the one query that
    writes the table: a batch that was published before changes nothing and returns
    False. Only the buckets that the batch touches are rewritten. ``buckets`` is fixed
    with the first batch.
    """
    spark = batch.sparkSession
    now = state(spark, base)
    if now is not None:
        last, buckets = (int(x) for x in now.split("/"))
        if batch_id <= last:
            return False
    row = F.struct(*batch.columns)
    newest = F.max_by(row, F.struct(F.col(order), row)) if order else F.max(row)
    rows = batch.groupBy(*[F.col(c).alias(f"_key_{c}") for c in key]).agg(newest.alias("_row")).select("_row.*")
    rows = rows.withColumn(CELL, bucket(key, buckets)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cells = [r[0] for r in rows.select(CELL).distinct().collect()]  # at most ``buckets``
        before = read(spark, base, cells)
        if before is not None:
            same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in key]
            left = before.alias("o").join(rows.select(*key).alias("n"), same, "left_anti")
            rows_after = left.withColumn(CELL, bucket(key, buckets)).unionByName(rows)
        else:
            rows_after = rows
        replace(rows_after, base, CELL, cells, f"{batch_id}/{buckets}")
    finally:
        rows.unpersist()
    return True


def lookup(spark: SparkSession, base: str, key: Sequence[str], values: Sequence) -> DataFrame | None:
    """SV-2 on a keyed table: the row of one key, from its bucket alone."""
    now = state(spark, base)
    if now is None:
        return None
    shape = spark.read.parquet(os.path.join(base, "data", "schema")).schema
    typed = [F.lit(v).cast(shape[k].dataType).alias(k) for k, v in zip(key, values)]
    cell = spark.range(1).select(*typed).select(bucket(key, int(now.split("/")[1]))).first()[0]
    out = read(spark, base, [cell])
    for k, v in zip(key, typed):
        out = out.where(F.col(k).eqNullSafe(v))
    return out


def expire(spark: SparkSession, base: str, older_than_seconds: float) -> list[str]:
    """Delete manifests and data versions that no manifest of the last
    ``older_than_seconds`` names; returns the deleted data versions. Call it with an age
    that no reader and no unfinished change reaches."""
    expire_versions(spark, base, MANIFEST, older_than_seconds)
    alive: set[str] = set()
    for d in fs.list_dirs(spark, os.path.join(base, MANIFEST)):
        kept = spark.read.schema(_SCHEMA).parquet(os.path.join(base, MANIFEST, d))
        alive |= {r[0].split("/")[1] for r in kept.select("path").distinct().collect()}
    limit = int((time.time() - older_than_seconds) * 1000)
    gone = [d for d in fs.list_dirs(spark, os.path.join(base, "data")) if d.startswith("v") and d not in alive and int(d[1:].split("-")[0]) < limit]
    for d in gone:
        fs.delete(spark, os.path.join(base, "data", d))
    return gone
