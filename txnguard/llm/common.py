"""Helpers shared by the operators: inputs, task output, scratch tables."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from txnguard.session import scratch_path
from txnguard.sinks import fs

#: Characters that a task handles at once; a longer text is a batch of its own.
BATCH_CHARS = 1_000_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that the operators read, under fixed names; null texts are empty."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def schema_with(docs: DataFrame, columns: str) -> T.StructType:
    """``doc_id`` as in ``docs``, then the columns of a DDL string."""
    rest = T.StructType.fromDDL(columns)
    return T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *rest.fields])


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables written inside are deleted at the end; those with ``keep`` belong
    to the scope around it, or stay if there is none."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        for path in paths:
            fs.delete(spark, path)


def materialise(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: what follows may read the rows several times, and survives
    the loss of an executor, since every executor sees the files. The shuffles of the
    write are given up with it, by a setting that holds for the write alone, and not only
    when the driver collects its garbage.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, tag), spark.conf.get(SHUFFLE_CLEANUP, None)
    owners = _SCOPES[:-1] if keep else _SCOPES
    if owners:
        owners[-1].append(path)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:  # the session leaves it at Spark's default
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(batches: Iterable[pa.RecordBatch], most: int = BATCH_CHARS) -> Iterator[tuple[pa.Array, list[str]]]:
    """Slices of Arrow batches with columns ``doc_id`` and ``text``: ids and texts of
    at most ``most`` characters together (one row at least)."""
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        sizes = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield ids.slice(first, i - first), texts.slice(first, i - first).to_pylist()
                first, held = i, 0
            held += int(n)
        if first < len(sizes):
            yield ids.slice(first), texts.slice(first).to_pylist()


def lean(run):
    """``run`` for ``mapInArrow``, after which the worker gives back the memory it took:
    workers outlive their tasks, and would else hold the most that any stage needed."""

    def task(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return task


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    """A record batch whose columns are cast to ``schema``."""
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
