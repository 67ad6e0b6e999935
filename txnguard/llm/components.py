"""Connected components of a graph given as a table of edges.

Alternates two contractions until nothing changes: each node links its larger
neighbours to its smallest one, then itself and its smaller neighbours to the
smallest. The edges end as stars around each component's smallest node, after a
few rounds even for long chains. Edges stay in tables throughout; a node with
very many edges is aggregated map-side and its join can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnguard.llm.common import materialise, scratch_scope


def _to_smallest(pairs: DataFrame, keep_self: bool) -> DataFrame:
    """For pairs (u, v): v linked to the smallest of u's neighbours and u."""
    # Written first, so that the join deals both sides itself and a hot node's rows can be split.
    least = materialise(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    out = pairs.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if keep_self:
        out = out.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a != b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges`` (columns a, b; any order, loops and
    repeats allowed); root is the component's smallest node."""
    now = materialise(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = None
    while True:
        sign = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if sign == seen or not sign[0]:
            break
        seen = sign
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        with scratch_scope(now.sparkSession):  # of a round only its edges stay
            large = _to_smallest(both, False).where("a > b")
            large = materialise(large.select(F.col("a").alias("u"), F.col("b").alias("v")), "large")
            now = materialise(_to_smallest(large, True), "small", keep=True)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
