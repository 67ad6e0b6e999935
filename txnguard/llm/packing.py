"""Best-fit packing of token sequences under several capacities at once.

Each document becomes its token ids and an end id; only longer ones are cut. A
bin (training sequence) has three capacities: tokens, documents, and attention
cost (the sum of squared piece lengths, what block-diagonal attention computes).
Pieces go largest first; each goes to the open bin, among those that hold it
under every capacity, whose residual vector is smallest after it (norm) or
points most its way (dot product); if none does, a new bin opens.

Pieces are dealt into groups of about ``group_pieces`` by a hash of their row, so
that no task holds more than that many; each group is packed on its own, which
costs at most the last, partly filled bins of a group.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from txnguard.llm.byte_bpe import ByteBpe
from txnguard.llm.common import arrow_schema, batch_of, id_text, materialise, schema_with, text_batches


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids; the first may be shorter."""
    first = (n - 1) % most + 1
    return [(0, first)] + [(s, most) for s in range(first, n, most)]


def vector_best_fit(
    lengths: np.ndarray, tokens: int, documents: int, attention: int, weights: tuple[float, float, float], score: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece.

    ``score``: "norm" takes the bin with the smallest weighted norm of the residual
    that is left, "dot" the one with the smallest weighted dot product of residual
    and demand (the tightest along what the piece needs). Ties go to the older bin.
    """
    full = np.array([tokens, documents, attention], float)[:, None]
    w = np.asarray(weights, float)[:, None]
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    least = int(lengths.min()) if len(lengths) else 0
    left = np.zeros((3, 64))  # residuals of open bins; what lies beyond ``n`` is unused
    name, used, n, made = np.zeros(64, np.int64), np.zeros(64, np.int64), 0, 0
    for k in np.argsort(-lengths, kind="stable"):
        need = np.array([lengths[k], 1, lengths[k] ** 2], float)[:, None]
        if (need > full).any():
            raise ValueError("a piece doesn't fit an empty bin")
        fits = np.flatnonzero((left[0, :n] >= need[0]) & (left[1, :n] >= need[1]) & (left[2, :n] >= need[2]))
        if len(fits):
            rest = left[:, fits] / full
            values = ((rest - need / full) ** 2 * w).sum(0) if score == "norm" else (rest * (need / full) * w).sum(0)
            b = fits[np.argmin(values)]
        else:
            if n == len(name):
                left, name, used = (np.concatenate([x, np.zeros_like(x)], axis=-1) for x in (left, name, used))
            b, n = n, n + 1
            left[:, b], name[b], used[b], made = full[:, 0], made, 0, made + 1
        bins[k], offsets[k] = name[b], used[b]
        left[:, b] -= need[:, 0]
        used[b] += lengths[k]
        if left[0, b] < least or left[1, b] < 1 or left[2, b] < least**2:  # nothing fits any more
            n -= 1
            for x in (left, name, used):
                x[..., b:n] = x[..., b + 1 : n + 1].copy()
    return bins, offsets


def pieces(docs: DataFrame, path: str, tokens: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: the pieces of every row of ``docs``."""
    source = id_text(docs, id_col, text_col)
    ByteBpe(path).check()
    schema = schema_with(source, "piece int, start long, length long, ids_crc32 long")
    arrow = arrow_schema(schema)

    def run(batches):
        bpe = ByteBpe(path)
        for ids, texts in text_batches(batches):
            flat, at = bpe.ids(texts)
            rows = []
            for i in range(len(texts)):
                own = np.append(flat[at[i] : at[i + 1]], end_id).astype("<u4")
                rows += [(i, p, s, n, zlib.crc32(own[s : s + n])) for p, (s, n) in enumerate(cut(len(own), tokens))]
            of, *rest = map(list, zip(*rows))
            yield batch_of(arrow, [ids.take(of), *rest])

    return source.mapInArrow(run, schema)


def best_fit_packing(
    docs: DataFrame,
    path: str,
    tokens: int = 2048,
    documents: int | None = None,
    attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
    score: str = "norm",
    group_pieces: int = 20_000,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``documents`` and ``attention`` cap a sequence's pieces and its attention cost;
    None sets them to what ``tokens`` allows at most, so that they only steer the
    choice. Pieces of full length are sequences of their own.

    A null text counts as empty: one piece that is the end id. A null id stays
    null; repeated rows are packed each; an empty table gives none; other columns
    are ignored.
    """
    documents, attention = documents or tokens, attention or tokens * tokens
    cutup = materialise(pieces(docs, path, tokens, end_id, id_col, text_col), "pieces")
    groups = max(1, math.ceil(cutup.where(F.col("length") < tokens).count() / group_pieces))
    schema = T.StructType([*cutup.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    row = F.monotonically_increasing_id()  # rows of written files: the same each time
    full = F.col("length") == tokens
    whole = cutup.select("*", row.alias("_row")).where(full).select(*cutup.columns, (-F.col("_row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = cutup.select("*", row.alias("_row")).where(~full).select("*", F.pmod(F.xxhash64("_row"), F.lit(groups)).alias("_group"))

    arrow, columns = arrow_schema(schema), cutup.columns

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("_row")
        bins, offsets = vector_best_fit(group["length"].to_numpy(), tokens, documents, attention, weights, score)
        ids = (group["_group"].to_numpy() << 32) + bins
        return pa.table([*(group[c] for c in columns), pa.array(ids), pa.array(offsets)], names=schema.names).cast(arrow)

    return whole.unionByName(part.groupBy("_group").applyInArrow(pack, schema))
