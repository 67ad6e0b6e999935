"""Small file-system helpers over the Hadoop FileSystem of the session, so the
same code works on local disk, HDFS or an object store."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty if it does not exist)."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path`` (empty if it does not exist)."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def create_marker(spark: SparkSession, path: str) -> None:
    """Create an empty file; it is there or not, on any file system."""
    fs, p, _ = _fs(spark, path)
    fs.create(p, False).close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def modified(spark: SparkSession, path: str) -> int:
    """When ``path`` was last changed, in milliseconds."""
    fs, p, _ = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())
