"""File and catalog sources: catalog tables (SRC-3), date-partitioned Parquet
(SRC-4), CSV with header (SRC-5) and ARFF (SRC-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import fs
from ..specs import DatasetSpec


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame | None:
    """SRC-3: a catalog table, or None when it does not exist (Q26)."""
    full = f"{database}.{name}" if database else name
    if not spark.catalog.tableExists(full):
        return None
    return spark.table(full)


def partitioned_schema(spec: DatasetSpec) -> T.StructType:
    s = spec.table_schema
    for p in spec.partition_cols:
        s = s.add(p, T.StringType(), True)
    return s


def read_partitioned(
    spark: SparkSession,
    path: str,
    spec: DatasetSpec | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    """SRC-4: Parquet laid out as year=/month=/day=, partitions discovered on
    every read (no repair step, Q25). Partition values stay strings. A date range
    ("YYYY-MM-DD", inclusive) prunes directories before any file is opened.
    """
    reader = spark.read.option("basePath", path)
    if spec is not None:
        reader = reader.schema(partitioned_schema(spec))
    df = reader.parquet(path)
    day = F.concat_ws("-", "year", "month", "day")
    if date_from:
        df = df.where(day >= F.lit(date_from))
    if date_to:
        df = df.where(day <= F.lit(date_to))
    return df


def read_landed(spark: SparkSession, path: str, spec: DatasetSpec, marked: bool = True) -> DataFrame:
    """Read what ``sinks.files.land`` wrote from decoded stream records: the
    record fields, and with ``marked`` the raw text, the reason and the
    ``quality`` partition. The schema is declared, so the partition values
    stay strings whatever the session's type-inference setting is."""
    fields = list(spec.stream_schema.fields)
    if marked:
        fields = [T.StructField("_raw", T.StringType())] + fields + [
            T.StructField("reason", T.StringType()),
            T.StructField("quality", T.StringType()),
        ]
    return spark.read.option("basePath", path).schema(T.StructType(fields)).parquet(path)


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create ``database`` if missing; with a location under shared storage
    (never the driver's working directory)."""
    if spark.catalog.databaseExists(database):
        return
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")


def partition_values(df: DataFrame, spec: DatasetSpec) -> list[tuple]:
    """The date partitions that ``df`` holds: a row a day."""
    return sorted(tuple(r) for r in df.select(*spec.partition_cols).distinct().collect())


def _listed(spark: SparkSession, path: str, columns: tuple) -> list[tuple]:
    """The partitions that are there, from the names of the folders alone."""
    found = [((), path)]
    for c in columns:
        found = [((*v, d.split("=", 1)[1]), f"{p}/{d}") for v, p in found for d in fs.list_dirs(spark, p) if d.startswith(f"{c}=")]
    return [v for v, _ in found]


def register_partitions(spark: SparkSession, name: str, spec: DatasetSpec, parts: list[tuple], database: str | None = None) -> None:
    """SRC-4: tell the catalog of new partitions (those it knows stay as they are);
    no folder is listed and no other partition touched."""
    full = f"{database}.{name}" if database else name

    def text(value) -> str:
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    clauses = ["PARTITION (" + ", ".join(f"`{c}`={text(v)}" for c, v in zip(spec.partition_cols, part)) + ")" for part in parts]
    for i in range(0, len(clauses), 500):
        spark.sql(f"ALTER TABLE {full} ADD IF NOT EXISTS " + " ".join(clauses[i : i + 500]))


def register_partitioned_table(
    spark: SparkSession, name: str, path: str, spec: DatasetSpec, database: str | None = None, parts: list[tuple] | None = None
) -> DataFrame:
    """Catalog form of SRC-4: an external Parquet table partitioned by date.

    An existing table stays, with its properties; it must lie at ``path``. ``parts`` are the
    partitions to add, as a landing wrote them; without, those whose folders are there.
    """
    full = f"{database}.{name}" if database else name
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in partitioned_schema(spec).fields)
    if not spark.catalog.tableExists(full):
        spark.sql(f"CREATE TABLE {full} ({cols}) USING parquet PARTITIONED BY ({', '.join(spec.partition_cols)}) LOCATION '{path}'")
    else:
        where = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = 'Location'").first()["data_type"]
        if where.split(":", 1)[-1].lstrip("/") != path.split(":", 1)[-1].lstrip("/"):
            raise ValueError(f"{full} lies at {where}, not at {path}")
    register_partitions(spark, name, spec, _listed(spark, path, spec.partition_cols) if parts is None else parts, database)
    return spark.table(full)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | DatasetSpec | None = None,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """SRC-5: CSV with a header line. With a schema the columns are typed on
    read (Q20); without one every column is a string, as in the reference."""
    reader = spark.read.option("header", True).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema.table_schema if isinstance(schema, DatasetSpec) else schema)
    return reader.csv(path)


_ARFF_TYPES = {"numeric": "double", "real": "double", "integer": "double", "string": "string"}


def _arff_header(spark: SparkSession, path: str) -> list[str]:
    """The ``@attribute`` lines, from the first file that has any, without going
    through the data: a file is read in steps, up to its first line of data."""
    for file in sorted(spark.read.text(path).inputFiles()):
        n, found = 256, []
        while True:
            lines = [r[0].strip() for r in spark.read.text(file).limit(n).collect()]
            stop = next((i for i, x in enumerate(lines) if x.lower().startswith("@data") or x[:1] not in ("", "@", "%")), None)
            found = [x for x in lines[:stop] if x.lower().startswith("@attribute")]
            if stop is not None or len(lines) < n:
                break
            n *= 4
        if found:
            return found
    return []


def read_arff(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: ARFF as a distributed text scan.

    Only the ``@attribute`` lines of the first file that has any reach the driver to
    build the schema; data lines are parsed on the executors with ``from_csv``. Nominal values become strings, ``?`` is NULL, quotes are stripped.
    """
    lines = spark.read.text(path).select(F.trim("value").alias("line"))
    header = [(x,) for x in _arff_header(spark, path)]
    fields = []
    for (line,) in header:
        rest = line.split(None, 1)[1].strip()
        if rest.startswith(("'", '"')):
            q = rest[0]
            name, kind = rest[1:].split(q, 1)
        else:
            name, kind = rest.split(None, 1)
        kind = kind.strip()
        dtype = "string" if kind.startswith("{") else _ARFF_TYPES.get(kind.lower().split()[0], "string")
        fields.append((name, dtype))
    raw = ", ".join(f"`{n}` string" for n, _ in fields)
    data = lines.where(
        (F.col("line") != "") & ~F.col("line").startswith("%") & ~F.col("line").startswith("@")
    )
    parsed = data.select(F.from_csv("line", raw, {"quote": "'", "nullValue": "?"}).alias("r"))
    return parsed.select(
        *[
            (F.trim(F.col(f"r.`{n}`")).try_cast(t) if t != "string" else F.trim(F.col(f"r.`{n}`"))).alias(n)
            for n, t in fields
        ]
    )
