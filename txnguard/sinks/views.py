"""SNK-1: publish a materialised view atomically.

The reference truncates a table and re-inserts rows one by one from the driver,
so readers can see an empty or half-filled view. Here every refresh writes a new
version directory with a distributed write (no ``collect``), and a marker file is
created in it once the job has committed. Readers take the newest version that
has its marker: nothing is ever renamed or overwritten, so they see the old or
the new version whole, on HDFS, local disks and object stores alike, and of two
writers the later version wins.
"""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fs

PUBLISHED = "_PUBLISHED"  # readers of data skip names that begin so
INDEX = "_index"  # file, lo, hi: the keys of each file of a clustered version


def _view_dir(out: str, view: str) -> str:
    return os.path.join(out.rstrip("/"), view)


def replace_view(
    spark: SparkSession, df: DataFrame, out: str, view: str, fmt: str = "parquet", key: str | None = None, files: int | None = None
) -> str:
    """Write ``df`` as the new version of ``view`` under ``out``; return its path.

    With ``key`` (Parquet only) the version is clustered for lookups: rows are dealt by
    ranges of the key and sorted in each file, so a key is in one file (AQE sizes
    them; ``files`` fixes their number), each file has a Bloom filter on the key, and
    an index of the files' key ranges is written beside them.
    """
    base = _view_dir(out, view)
    version = f"v{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    path = os.path.join(base, version)
    if key is None:
        df.write.mode("errorifexists").format(fmt).save(path)
    else:
        ranged = df.repartitionByRange(*([files] if files else []), key).sortWithinPartitions(key)
        ranged.write.mode("errorifexists").option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path)
        # One column of the version, a row a file.
        keys = spark.read.schema(df.schema).parquet(path).select(F.col("_metadata.file_name").alias("file"), key)
        index = keys.groupBy("file").agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
        index.coalesce(1).write.parquet(os.path.join(path, INDEX))
    fs.create_marker(spark, os.path.join(path, PUBLISHED))
    return path


def expire_versions(spark: SparkSession, out: str, view: str, older_than_seconds: float) -> list[str]:
    """Delete versions of ``view`` published longer ago than that, never the current
    one; returns their names. Publishing deletes nothing: call this with an age
    that no reader of an old version reaches."""
    base, current = _view_dir(out, view), current_path(spark, out, view)
    limit = int((time.time() - older_than_seconds) * 1000)
    old = [d for d in fs.list_dirs(spark, base) if d.startswith("v") and int(d[1:].split("-")[0]) < limit and os.path.join(base, d) != current]
    for d in old:
        fs.delete(spark, os.path.join(base, d))
    return old


def current_path(spark: SparkSession, out: str, view: str) -> str | None:
    base = _view_dir(out, view)
    for d in sorted((d for d in fs.list_dirs(spark, base) if d.startswith("v")), reverse=True):
        if fs.exists(spark, os.path.join(base, d, PUBLISHED)):
            return os.path.join(base, d)
    return None


def read_view(spark: SparkSession, out: str, view: str, fmt: str = "parquet") -> DataFrame | None:
    path = current_path(spark, out, view)
    return spark.read.format(fmt).load(path) if path else None


def lookup_view(spark: SparkSession, out: str, view: str, key: str, value) -> DataFrame | None:
    """SV-2: the rows of ``view`` with ``key == value``. Of a version clustered by ``key`` only
    the files are read whose range holds the value (one, for a view's primary key)."""
    path = current_path(spark, out, view)
    if path is None:
        return None
    whole = spark.read.parquet(path)
    same = F.col(key) == F.lit(value)
    if not fs.exists(spark, os.path.join(path, INDEX, "_SUCCESS")):
        return whole.where(same)
    index = spark.read.parquet(os.path.join(path, INDEX))
    found = [r["file"] for r in index.where(F.lit(value).between(F.col("lo"), F.col("hi"))).select("file").collect()]
    if not found:
        return spark.createDataFrame([], whole.schema)
    return spark.read.schema(whole.schema).parquet(*(os.path.join(path, f) for f in found)).where(same)
