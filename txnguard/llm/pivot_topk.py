"""Exact top-k by inner product through a pivot-distance index.

Vectors x of norm at most M become points (x, sqrt(M^2 - |x|^2)), queries (q, 0): then
|x' - q'|^2 = M^2 + |q|^2 - 2 <x, q>, so the largest inner products are the nearest
points. Each point is keyed by its nearest pivot and its distance to it; points
of one pivot in one range of distances are an annulus. By the triangle inequality
no point of an annulus [lo, hi] is nearer to the query than
max(0, d(q', pivot) - hi, lo - d(q', pivot)).

Equal query vectors are searched once, for k + 1 rows, and each query then leaves
out its own row. A query first searches the annuli of the best bounds, as many as hold enough
points, and gets a k-th best score; then all others whose bound reaches that
score. Annuli and queries meet in groups of bounded size and are scored by matrix
products. Pivots and ranges come from a sample of bounded size and only steer the
work: bounds are computed from all rows, results are exact.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from txnguard.llm.common import arrow_schema, batch_of, materialise


#: Bounds (queries times annuli) that a task holds at once.
BOUNDS = 1 << 20


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, x`` with x = floor(scale * component); rows with a null id, a null vector
    or a null or non-finite component are left out."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad).select(
        F.col(id_col).alias("vec_id"), F.transform(v, lambda x: F.floor(x * F.lit(float(scale)))).cast("array<long>").alias("x")
    )


def matrix(column, size: int) -> np.ndarray:
    """Rows of a list column; shorter ones are padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), size), np.int64)
    out[np.arange(size) < lengths[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows; in floating point where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(float) @ b.T.astype(float)).astype(np.int64) if most < 2**53 else a @ b.T


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    x = x.astype(float)
    return np.column_stack([x, np.sqrt(np.maximum(most - (x * x).sum(1), 0))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(points: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """Centres of a few rounds of k-means over the sample, from its first points."""
    centres = points[:count].copy()
    for _ in range(rounds):
        near = distances(points, centres).argmin(1)
        for i in range(len(centres)):
            if (near == i).any():
                centres[i] = points[near == i].mean(0)
    return centres


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's k best, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    columns = order[np.argsort(~scores[:, order], axis=1, kind="stable")[:, :k]]  # ~x falls as x rises, without overflow
    return np.repeat(np.arange(len(scores)), columns.shape[1]), columns.reshape(-1)


def pivot_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    pivots: int = 32,
    sample: int = 4096,
    cell_rows: int = 1024,
    most_cells: int = 65536,
    group_rows: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` (over ``vec_id``)
    holds, the k best other rows by the inner product of their integer vectors; all
    if there are fewer; ties to the smaller vec_id.

    Rows with a null id, a null vector or a null or non-finite component take no
    part. Shorter vectors are padded with zeros. Repeated rows (same id and vector)
    count once; rows that share only the id are different rows. An empty table
    gives none; other columns are ignored. Scores wrap beyond 64 bits.

    ``sample`` bounds the rows that pivots and ranges are chosen from, ``most_cells``
    the number of annuli, whose table of bounds is the only thing sent to all tasks.
    """
    spark = vectors.sparkSession
    ints = quantised(vectors, id_col, vector_col, scale)
    # Equal vectors score alike: of each, only the k + 1 smallest ids can be among a query's k best others.
    equal = Window.partitionBy("x").orderBy("vec_id")
    held = ints.withColumn("_nth", F.dense_rank().over(equal)).where(F.col("_nth") <= k + 1).groupBy("x", "vec_id").agg(F.count("*").alias("n"))
    norm = F.aggregate("x", F.lit(0.0), lambda a, y: a + y.cast("double") * y)
    kept = materialise(held.select("vec_id", "x", norm.alias("norm")), "vectors")
    size, most, rows = kept.agg(F.max(F.size("x")), F.max("norm"), F.count("*")).first()
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    taken = kept.orderBy(F.xxhash64("vec_id", "x")).limit(sample).select("x").toArrow()
    points = lifted(matrix(taken["x"], size), most)
    centres = choose_pivots(points, pivots)
    # Ranges of distance: as many a pivot as the table needs, at the sample's quantiles.
    near = distances(points, centres)
    per_pivot = min(max(1, math.ceil(rows / (len(centres) * cell_rows))), max(1, most_cells // len(centres)))
    quantiles = np.linspace(0, 1, per_pivot + 1)[1:-1]
    edges = [np.quantile(near[near.argmin(1) == i, i], quantiles) if (near.argmin(1) == i).any() else np.zeros(len(quantiles)) for i in range(len(centres))]

    index_schema = arrow_schema(schema_of := kept.select("vec_id", "x", F.lit(0).alias("cell"), F.lit(0.0).alias("r")).schema)

    def assign(batches):
        for batch in batches:
            d = distances(lifted(matrix(batch.column("x"), size), most), centres)
            pivot = d.argmin(1)
            r = d[np.arange(len(d)), pivot]
            cell = pivot * per_pivot + np.array([np.searchsorted(edges[p], x) for p, x in zip(pivot, r)], np.int64)
            yield batch_of(index_schema, [batch.column("vec_id"), batch.column("x"), cell, r])

    index = materialise(kept.mapInArrow(assign, schema_of), "index")
    # At most ``most_cells`` rows.
    cells = index.groupBy("cell").agg(F.count("*").alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi")).orderBy("cell").toArrow()
    cell, count, lo, hi = (cells[c].to_numpy() for c in cells.column_names)

    def bounds(x: np.ndarray) -> np.ndarray:
        """The most that a vector of each cell can score."""
        q = np.column_stack([x.astype(float), np.zeros(len(x))])
        d = distances(q, centres)[:, cell // per_pivot]
        apart = np.maximum(np.maximum(d - hi, lo - d) - 1e-6 * (1 + d + hi), 0)
        most_score = (most + (q * q).sum(1)[:, None] - apart**2) / 2
        return most_score + 1 + 1e-9 * np.abs(most_score)

    enough = max(4 * (k + 1), cell_rows)

    def probes(first: bool, probe_schema):
        def run(batches):
            step = max(1, BOUNDS // len(cell))  # rows whose bounds a task holds at once
            for batch in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
                bound = bounds(matrix(batch.column("x"), size))
                order = np.argsort(-bound, axis=1, kind="stable")
                before = np.cumsum(count[order], axis=1) - count[order]
                early = np.zeros(bound.shape, bool)
                np.put_along_axis(early, order, before < enough, axis=1)
                if first:
                    chosen = early
                else:
                    least = batch.column("least").to_numpy(zero_copy_only=False)
                    chosen = ~early & ((bound >= least[:, None]) | np.isnan(least)[:, None])
                row, at = np.nonzero(chosen)
                yield batch_of(probe_schema, [*(batch.column(c).take(pa.array(row)) for c in ("q", "x")), cell[at]])

        return run

    asking = materialise(ints.where(is_query).distinct(), "queries")
    queries = materialise(asking.select("x").distinct().withColumn("q", F.monotonically_increasing_id()), "asked")
    probe_type = queries.select("q", "x", F.lit(0).alias("cell")).schema
    result = "q long, vec_id long, score long, same boolean"

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = matrix(left["x"], size), matrix(right["x"], size)
        scores = products(a, b)
        row, column = best(scores, right["vec_id"].to_numpy(), k + 1)
        found = [left["q"].to_numpy()[row], right["vec_id"].to_numpy()[column], scores[row, column], (a[row] == b[column]).all(1)]
        return pa.table(dict(zip(("q", "vec_id", "score", "same"), found)))

    def scored(asked: DataFrame) -> DataFrame:
        """Cells and the queries that ask for them meet in parts of ``group_rows`` each."""
        asked = materialise(asked, "probes")
        parts = asked.groupBy("cell").agg(F.count("*").alias("n_q")).join(index.groupBy("cell").agg(F.count("*").alias("n_x")), "cell")
        parts = F.broadcast(parts.select("cell", F.ceil(F.col("n_q") / group_rows).cast("int").alias("pq"), F.ceil(F.col("n_x") / group_rows).cast("int").alias("px")))

        def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
            mine = F.pmod(F.xxhash64("x", *{"vec_id", "q"}.intersection(df.columns)), F.col(own)).cast("int").alias(f"_{own}")
            return df.join(parts, "cell").select(*df.columns, mine, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"_{other}"))

        keys = ["cell", "_pq", "_px"]
        return dealt(asked, "pq", "px").groupBy(*keys).cogroup(dealt(index, "px", "pq").groupBy(*keys)).applyInArrow(search, result)

    def top(found: DataFrame, n: int, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    first = materialise(top(scored(queries.mapInArrow(probes(True, arrow_schema(probe_type)), probe_type)), k + 1, "q"), "first")
    least = first.where(F.col("rank") == k + 1).select("q", F.col("score").cast("double").alias("least"))
    rest = queries.join(least, "q", "left").select("q", "x", "least")
    second = scored(rest.mapInArrow(probes(False, arrow_schema(probe_type)), probe_type))
    found = materialise(top(first.drop("rank").unionByName(second), k + 1, "q"), "found")
    # Each query takes its vector's rows but its own; those below its own move up by one.
    named = asking.join(queries, "x").select(F.col("vec_id").alias("query_id"), "q")
    own = found.where("same").select("q", F.col("vec_id").alias("query_id"), F.col("rank").alias("own"))
    moved = F.col("rank") - F.when(F.col("own") < F.col("rank"), 1).otherwise(0)
    all_rows = named.join(own, ["q", "query_id"], "left").join(found, "q")
    return all_rows.where(F.col("own").isNull() | (F.col("own") != F.col("rank"))).select("query_id", moved.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
