"""Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases: each phrase is the shortest string from
the current place that isn't a phrase yet. The set of phrases is what a compressor
would learn from the text; two texts are alike by how much of it they share. The
set is hashed and its smallest hashes are the signature, from which the share of
common phrases (Jaccard) is estimated without bias; for short texts it is exact.

To compare each text with its neighbour by id, rows are dealt into ranges of ids
and sorted inside them, so that the text is shuffled once; the first row of each
range goes to the range before as well.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from txnguard.llm.common import arrow_schema, batch_of, id_text, schema_with, text_batches
from txnguard.llm.span_hash import SpanHash

NODE = 1 << 21  # beyond any code point
DIGITS = 8


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Parser:
    """Parses on from what is parsed; ``ends`` are where phrases end."""

    def __init__(self):
        self.nodes: dict[int, int] = {}
        self.node, self.at, self.ends = 0, 0, []

    def copy(self) -> "Parser":
        other = Parser()
        other.nodes, other.node, other.at, other.ends = self.nodes.copy(), self.node, self.at, self.ends.copy()
        return other

    def feed(self, points: list[int]) -> "Parser":
        nodes, node, ends = self.nodes, self.node, self.ends
        get = nodes.get
        for at, c in enumerate(points, self.at + 1):
            key = node * NODE + c
            node = get(key)
            if node is None:
                nodes[key] = len(nodes) + 1
                ends.append(at)
                node = 0
        self.node, self.at = node, self.at + len(points)
        return self

    def phrases(self) -> np.ndarray:
        """Where phrases begin, and the text's end; an unfinished phrase is the last."""
        tail = [self.at] if not self.ends or self.ends[-1] != self.at else []
        return np.array([0, *self.ends, *tail], np.int64) if self.at else np.zeros(1, np.int64)


def signature(points: np.ndarray, phrases: np.ndarray, size: int, hashed: SpanHash) -> np.ndarray:
    """The ``size`` smallest distinct 32-bit hashes of the phrases."""
    h = hashed(points, phrases)
    h ^= h >> np.uint64(31)
    return np.unique(((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32))[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int) -> float:
    """Share of common hashes among the ``size`` smallest of both; 1 for two empty texts."""
    both = np.union1d(a, b)[:size]
    if not len(both):
        return 1.0
    return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), both, assume_unique=True)) / len(both)


def written(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def _place(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most ``value``, by bisection."""
    if not bounds:
        return F.lit(0)
    table = F.array(*(F.lit(b) for b in bounds)) if len(bounds) < 64 else F.from_json(F.lit(str(bounds)), "array<bigint>")

    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        right = F.element_at(table, mid + 1) <= value
        stop = acc["lo"] >= acc["hi"]
        return F.struct(
            F.when(~stop & right, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(~stop & ~right, mid).otherwise(acc["hi"]).alias("hi")
        )

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
    # Beyond the end, element_at is not asked: ``stop`` holds there first.
    return F.aggregate(steps, start, step, lambda acc: acc["lo"])


def lz_fingerprints(
    docs: DataFrame, size: int = 64, range_bytes: int = 8 << 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text is the row's, its last quarter (rounded down) replaced by the
    first as many code points of the next row in ascending id (after the last: the
    first). ``near_*`` are the likeness of the fingerprint to the edited text's and
    the next row's, 0 to 1. Fingerprints hold at most ``size`` hashes of 8 hex digits.

    Ids are integers. A null id comes first in the order and stays null; rows of one
    id are ordered by text. A null text counts as empty: an empty fingerprint, alike
    (1) to an empty one only. A single row is its own next; an empty table gives
    none; other columns are ignored. Texts are processed whole; memory follows the
    longest text.
    """
    source = id_text(docs, id_col, text_col).withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))
    schema = schema_with(source, "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    arrow = arrow_schema(schema)
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Ranges follow the input; what the driver holds of each is two ids.
    n = max(1, math.ceil(total / range_bytes))
    bounds = source.agg(F.percentile_approx("_key", [i / n for i in range(1, n)], 10 * n)).first()[0] if n > 1 else None
    bounds = sorted(set(bounds or []))
    firsts = dict(source.select(_place(F.col("_key"), bounds).alias("b"), "_key").groupBy("b").agg(F.min("_key")).collect())
    filled = sorted(firsts)
    first = [firsts.get(b, 0) for b in range(len(bounds) + 1)]
    before = [max((x for x in filled if x < b), default=max(filled, default=0)) for b in range(len(bounds) + 1)]
    at = _place(F.col("_key"), bounds) + 1
    own = F.struct(F.lit(False).alias("extra"), (at - 1).alias("range"))
    extra = F.struct(F.lit(True).alias("extra"), F.element_at(F.from_json(F.lit(str(before)), "array<int>"), at).alias("range"))
    is_first = F.col("_key") == F.element_at(F.from_json(F.lit(str(first)), "array<bigint>"), at)
    dealt = (
        source.withColumn("_to", F.explode(F.when(is_first, F.array(own, extra)).otherwise(F.array(own))))
        .select("doc_id", "text", "_key", F.col("_to.range").alias("_range"), F.col("_to.extra").alias("_extra"))
        .repartition("_range")
        .sortWithinPartitions("_range", "_extra", "_key", "text")
    )

    def run(batches):
        hashed = SpanHash()

        def rows():
            for batch in batches:
                meta = list(zip(batch.column("_range").to_pylist(), batch.column("_extra").to_pylist()))
                k = 0
                for ids, texts in text_batches([batch.select(["doc_id", "text"])]):
                    for i, text in zip(ids.to_pylist(), texts):
                        yield (*meta[k], i, text)
                        k += 1

        def finished(before, text):
            """The row of ``before``, whose next text is ``text``."""
            doc_id, mine, cut, parsed, kept, fp = before
            points = code_points(text)
            tail = points[: len(mine) - cut]
            edited = np.concatenate([mine[:cut], tail])
            other = kept.feed(tail.tolist())
            edited_fp = signature(edited, other.phrases(), size, hashed)
            raw = edited.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            return doc_id, len(mine), hashlib.sha256(raw).hexdigest(), fp, edited_fp

        out, held, now = [], None, None
        for where, is_extra, doc_id, text in rows():
            if held is not None and where == now:
                row = finished(held, text)
            else:
                row = None
            if is_extra and row is None:
                held = None  # a further row of the first id
                continue
            points = code_points(text)
            cut = len(points) - len(points) // 4
            parser = Parser().feed(points[:cut].tolist())
            kept = None if is_extra else parser.copy()
            fp = signature(points, parser.feed(points[cut:].tolist()).phrases(), size, hashed)
            if row is not None:
                i, chars, digest, a, b = row
                out.append((i, chars, digest, written(a), written(b), likeness(a, b, size), likeness(a, fp, size)))
                if len(out) >= 1000:
                    yield batch_of(arrow, list(map(list, zip(*out))))
                    out = []
            held, now = (None if is_extra else (doc_id, points, cut, parser, kept, fp)), where
        if out:
            yield batch_of(arrow, list(map(list, zip(*out))))

    return dealt.mapInArrow(run, schema)
