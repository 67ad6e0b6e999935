"""Hard negatives by anchor clusters that share candidate lists (MAXIMUS-style).

Anchors are clustered by direction. A member of a cluster is at most ``radius`` from its
centre, so by the triangle inequality for angles a candidate x at the angle t of the
centre scores at most |anchor| * |x| * cos(max(0, t - radius)) with any of them: |x| *
cos(...) orders one list for the whole cluster. Members walk their list from the top and
stop where the bound falls below all that they still look for. Nothing is missed.

Lists are sorted once, by dealing: bounds of the list's segments are taken from a
bounded sample, and a candidate's segment in each cluster follows from its vector. A
walk is one round a segment. In each round only the segments that some member still
reads are dealt out, and only to the members that read them, in parts of bounded size that
are scored by matrix products; what a member holds is merged by key.

Two walks: one for the positives (each label's part of the list is a list of its own),
one for the negatives, when each positive's window of scores is known.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from txnguard.llm.common import arrow_schema, batch_of, materialise
from txnguard.llm.pivot_topk import matrix, products

SLACK = 1e-6  # relative, well above rounding of the bounds


class Lists:
    """Centres, radii and segments of the clusters' lists; ``floors[c]`` are the
    smallest bounds of all segments of c but the last."""

    def __init__(self, centres: np.ndarray, radius: np.ndarray, floors: np.ndarray):
        self.centres, self.radius, self.floors = centres, radius, floors

    @staticmethod
    def angles(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Angle of each row to each centre, and norms; a null vector is at no angle of any."""
        x = x.astype(float)
        norm = np.sqrt((x * x).sum(1))
        cosine = (x @ centres.T) / np.where(norm > 0, norm, 1)[:, None]
        return np.where(norm[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0), norm

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """The most that a row can score with a member of each cluster of norm 1."""
        angle, norm = self.angles(x, self.centres)
        return norm[:, None] * (np.cos(np.maximum(angle - self.radius - SLACK, 0)) + SLACK)

    def segments(self, x: np.ndarray, clusters: np.ndarray) -> np.ndarray:
        """The segment of each row in the lists of ``clusters``."""
        return (self.bounds(x)[:, clusters, None] < self.floors[None, clusters]).sum(2)


def spherical_centres(x: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of a few rounds of k-means by angle, from the first distinct directions."""
    norm = np.sqrt((x * x).sum(1))
    x = np.unique(x[norm > 0] / norm[norm > 0, None], axis=0) if (norm > 0).any() else np.eye(1, max(x.shape[1], 1))[:, : x.shape[1]]
    centres = x[np.linspace(0, len(x) - 1, min(count, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = (x @ centres.T).argmax(1)
        for i in range(len(centres)):
            middle = x[near == i].sum(0)
            length = np.sqrt((middle * middle).sum())
            if length > 0:
                centres[i] = middle / length
    return centres


def leading(group: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the k first of their group: higher scores, then smaller ids."""
    order = np.lexsort((row, ids, ~score, group))  # ~x falls as x rises, without overflow
    begin = np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1])) if len(order) else order
    nth = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    return order[nth < k]


def searcher(size: int, keep: int, same_label: bool, slice_rows: int = 1024):
    """Scores the readers and the rows of one group; see ``walk``."""

    def search(_, asked: pa.Table, held: pa.Table) -> pa.Table:
        # An anchor that looks for several things is multiplied once.
        own = asked["row"].to_numpy()
        _, one, of = np.unique(own, return_index=True, return_inverse=True)
        a = matrix(asked["x"].take(pa.array(one)), size)
        want, label, least, most = (asked[c].to_numpy() for c in ("want", "label", "least", "most"))
        found = [[np.zeros(0, np.int64)] * 4]
        for s in range(0, held.num_rows, slice_rows):
            part = held.slice(s, slice_rows)
            row, ids = part["row"].to_numpy(), part["vec_id"].to_numpy()
            score = products(a, matrix(part["x"], size))[of]
            allowed = (label[:, None] == part["label"].to_numpy()) == same_label
            allowed &= (own[:, None] != row) & (score >= least[:, None]) & (score <= most[:, None])
            if len(row) > keep:  # the keep-th best of each reader
                at = len(row) - keep
                allowed &= score >= np.partition(np.where(allowed, score, np.iinfo(np.int64).min), at, axis=1)[:, at : at + 1]
            i, j = np.nonzero(allowed)
            best = leading(i, score[i, j], ids[j], row[j], keep)
            i, j = i[best], j[best]
            found.append([i, score[i, j], ids[j], row[j]])
        i, score, ids, row = (np.concatenate(c) for c in zip(*found))
        best = leading(i, score, ids, row, keep)
        return pa.table({"want": want[i[best]], "vec_id": ids[best], "row": row[best], "score": score[best]})

    return search


FOUND = "want long, vec_id long, row long, score long"


def walk(members: DataFrame, rows: DataFrame, lists: Lists, size: int, keep: int, same_label: bool, part_members: int, part_rows: int, tag: str):
    """Each member's first ``keep`` rows in its window of scores, and how far it walked.

    ``members``: want (unique), row (the anchor's own, which isn't to be found), label, cluster,
    norm, x, least, most (the window, both ends included). ``rows``: row, vec_id, label, x. With
    ``same_label`` rows of the member's label are looked for, else those of all others.
    Returns ``want, vec_id, row, score`` and ``want, walked``, the number of segments read.
    """
    spark = rows.sparkSession
    segments = lists.floors.shape[1] + 1
    key = ["cluster", "label"] if same_label else ["cluster"]
    found_in = Window.partitionBy("want").orderBy(F.desc("score"), "vec_id", "row")
    place_type = rows.select("row", "vec_id", "label", "x", F.lit(0).alias("cluster")).schema
    place_arrow = arrow_schema(place_type)
    left, best, stopped = materialise(members, f"{tag}-members"), spark.createDataFrame([], FOUND), []

    def parts(df: DataFrame, most: int, name: str) -> DataFrame:
        return df.groupBy(*key).agg(F.ceil(F.count("*") / most).cast("int").alias(name))

    def dealt(df: DataFrame, counts: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("row"), F.col(f"n{own}")).cast("int").alias(own)
        return df.join(counts, key).select(*df.columns, mine, F.explode(F.sequence(F.lit(0), F.col(f"n{other}") - 1)).alias(other))

    for segment in range(segments):
        # The clusters whose members read on; there are as many as centres at most.
        reading = np.array(sorted(r[0] for r in left.select("cluster").distinct().collect()), np.int64)
        if not len(reading):
            break

        def place(batches, segment=segment, reading=reading):
            for batch in batches:
                for s in range(0, batch.num_rows, 1024):
                    part = batch.slice(s, 1024)
                    row, at = np.nonzero(lists.segments(matrix(part.column("x"), size), reading) == segment)
                    yield batch_of(place_arrow, [*(part.column(c).take(pa.array(row)) for c in ("row", "vec_id", "label", "x")), reading[at]])

        held = rows.select("row", "vec_id", "label", "x").mapInArrow(place, place_type)
        counts = parts(left, part_members, "n_m").join(parts(held, part_rows, "n_r"), key)
        group = [*key, "_m", "_r"]
        asked, listed = dealt(left, counts, "_m", "_r"), dealt(held, counts, "_r", "_m")
        found = asked.groupBy(*group).cogroup(listed.groupBy(*group)).applyInArrow(searcher(size, keep, same_label), FOUND)
        best = best.unionByName(found).withColumn("_nth", F.row_number().over(found_in)).where(F.col("_nth") <= keep).drop("_nth")
        best = materialise(best, f"{tag}-best")
        if segment + 1 == segments:
            break
        # What is still of use: nothing below the last one held, once all places are taken.
        full = best.groupBy("want").agg(F.count("*").alias("_n"), F.min("score").alias("_last")).where(F.col("_n") >= keep).select("want", "_last")
        below = F.element_at(F.array(*(F.lit(float(b)) for b in lists.floors[:, segment])), F.col("cluster") + 1)
        useful = F.greatest("least", F.coalesce("_last", "least"))
        turn = left.join(full, "want", "left").withColumn("_on", F.col("norm") * below >= useful.cast("double") - 1).drop("_last")
        turn = materialise(turn, f"{tag}-turn")
        stopped.append(turn.where("NOT _on").select("want", F.lit(segment + 1).alias("walked")))
        left = turn.where("_on").drop("_on")
    walked = left.select("want", F.lit(segments).alias("walked"))
    for more in stopped:
        walked = walked.union(more)
    return best, walked


NULL_ID = -(1 << 63)
FAR = 1 << 62


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
    clusters: int = 16,
    segments: int = 4,
    sample: int = 4096,
    part_members: int = 2048,
    part_rows: int = 8192,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    with_walk: bool = False,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become floor(``scale`` * x); a score is the integer inner product with the
    anchor; higher scores come first, ties by smaller id. Anchors are the rows where
    ``is_anchor`` holds, their positives the first ``positives`` other rows of the same
    label. For each of them come the first ``negatives`` rows of other labels whose score is
    between ``window`` per cent of the positive's, both included (so none for a negative
    one). ``label`` replaces the label column. All are given if there are fewer.
    ``with_walk=True`` adds ``walked``, the segments of its list that the anchor read.

    Rows with a null label, a null vector or a null or non-finite component take no part.
    Each other row counts for itself, repeated ones and those that share an id too. A
    null id is smaller than all others and stays null. Shorter vectors are padded with
    zeros. An empty table gives none; other columns are ignored. Scores wrap beyond 64 bits.

    ``sample`` bounds the rows that centres and segments are taken from; they only steer
    the work. ``clusters`` bounds the lists. ``part_members`` and ``part_rows`` bound a task's group.
    """
    spark = vectors.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long" + (", walked int" if with_walk else "")
    v = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    group = F.col(f"`{label_col}`") if label is None else label
    ints = vectors.where(v.isNotNull() & ~bad & group.isNotNull()).select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("vec_id"),
        group.cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x * F.lit(float(scale)))).cast("array<long>").alias("x"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    # Written before rows are numbered, so that a row keeps its number.
    rows = materialise(materialise(ints, "vectors").withColumn("row", F.monotonically_increasing_id()), "rows")
    size, n = rows.agg(F.max(F.size("x")), F.count_if("anchor")).first()
    if not n:
        return spark.createDataFrame([], result)
    size = max(size, 1)

    def sampled(df: DataFrame) -> np.ndarray:
        return matrix(df.orderBy(F.xxhash64("row")).limit(sample).select("x").toArrow()["x"], size)

    centres = spherical_centres(sampled(rows.where("anchor")).astype(float), clusters)
    anchors = rows.where("anchor").select("row", "vec_id", "label", "x")
    member_type = anchors.select("*", F.lit(0).alias("cluster"), F.lit(0.0).alias("norm"), F.lit(0.0).alias("angle")).schema
    member_arrow = arrow_schema(member_type)

    def join_cluster(batches):
        for batch in batches:
            angle, norm = Lists.angles(matrix(batch.column("x"), size), centres)
            near = angle.argmin(1)
            yield batch_of(member_arrow, [*batch.columns, near, norm, angle[np.arange(len(near)), near]])

    members = materialise(anchors.mapInArrow(join_cluster, member_type), "clusters")
    radius = np.zeros(len(centres))
    for c, angle in members.groupBy("cluster").agg(F.max("angle")).collect():  # a row a centre
        radius[c] = angle
    lists = Lists(centres, radius, np.zeros((len(centres), 0)))
    # Segments grow fourfold towards the end of the list.
    shares = 1 - 0.25 ** np.arange(segments - 1, 0, -1)
    lists.floors = np.quantile(lists.bounds(sampled(rows)), shares, axis=0).T

    open_end = members.select(F.col("row").alias("want"), "row", "label", "cluster", "norm", "x", F.lit(-FAR).alias("least"), F.lit(FAR).alias("most"))
    best, _ = walk(open_end, rows, lists, size, positives, True, part_members, part_rows, "positives")
    low, high = window
    score = F.col("positive_score")
    pairs = best.select(F.col("want").alias("row"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(members, "row").where(score >= 0)
    pairs = pairs.withColumns({"least": F.expr(f"(positive_score * {low} + 99) div 100"), "most": F.expr(f"positive_score * {high} div 100")})
    pairs = materialise(pairs.withColumn("want", F.monotonically_increasing_id()), "pairs")
    wanted = pairs.select("want", "row", "label", "cluster", "norm", "x", "least", "most")
    found, walked = walk(wanted, rows, lists, size, negatives, False, part_members, part_rows, "negatives")
    found = found.select("want", F.col("vec_id").alias("_negative"), F.col("score").alias("negative_score"), F.col("row").alias("_row"))
    nth = Window.partitionBy("want").orderBy(F.desc("negative_score"), "_negative", "_row")
    out = found.withColumn("rank", F.row_number().over(nth)).join(pairs.select("want", "vec_id", "positive_id", "positive_score"), "want")
    if with_walk:
        out = out.join(walked, "want")

    def named(c: str) -> Column:
        return F.when(F.col(c) != NULL_ID, F.col(c))

    return out.select(
        named("vec_id").alias("anchor_id"),
        named("positive_id").alias("positive_id"),
        "rank",
        named("_negative").alias("negative_id"),
        "positive_score",
        "negative_score",
        *(["walked"] if with_walk else []),
    )
