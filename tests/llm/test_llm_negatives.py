"""Hard negatives against brute force; the lists' bounds; how far members walk."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from txnguard.llm import oracle_sql
from txnguard.llm.hard_negatives import Lists, hard_negatives, leading, spherical_centres

NULL = -(1 << 63)


def brute(rows, positives, negatives, low=30, high=90, scale=256):
    held = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            held.append((NULL if i is None else i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    size = max((len(x) for *_, x in held), default=0)
    table = np.array([x + [0] * (size - len(x)) for *_, x in held], np.int64).reshape(len(held), size)
    out = Counter()
    for a, (i, label, _) in enumerate(held):
        if i == NULL or i % 100:
            continue
        score = (table @ table[a]).tolist()
        order = sorted((c for c in range(len(held)) if c != a), key=lambda c: (-score[c], held[c][0]))
        for p in [c for c in order if held[c][1] == label][:positives]:
            fits = [c for c in order if held[c][1] != label and low * score[p] <= 100 * score[c] <= high * score[p]][:negatives]
            for rank, c in enumerate(fits):
                out[i, held[p][0], rank + 1, held[c][0], score[p], score[c]] += 1
    return out


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.repartition(3).selectExpr("*", "1 row", "'x' want", "2 cluster", "3 x")


def mined(df, **options):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives(df, F.col("vec_id") % 100 == 0, label, **options).collect()
    return Counter(tuple(NULL if x is None else x for x in r) for r in rows)


RNG = np.random.default_rng(3)
PLAIN = [(i, RNG.normal(size=6).tolist(), int(RNG.integers(0, 10))) for i in range(600)]


def test_plain(spark):
    got = mined(table(spark, PLAIN), clusters=3, segments=3, part_members=4, part_rows=64)
    assert got == brute(PLAIN, 5, 10)


def test_copies_ties_repeats_and_odd_rows(spark):
    same = [0.5, 0.25, 0.0, 0.0, 0.0, 0.0]
    rows = [(i, same if i % 3 else v, lab) for i, v, lab in PLAIN[:400]]
    rows += rows[:2] + rows[100:102] + [(100, same, 4), (700, None, 1), (701, same, None), (702, [None, 1.0], 1), (703, [float("nan")], 1), (800, [float("inf")], 2)]
    rows += [(900, [], 3), (1000, [0.0] * 6, 3), (1001, [0.1], 3), (None, same, 2), (None, same, 5), (1100, [-x for x in same], 5)]
    got = mined(table(spark, rows), clusters=2, segments=2, part_members=8, part_rows=128)
    assert got == brute(rows, 5, 10)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(100, [1.0, 2.0], 1)], [(0, [], 1), (100, [], 2)], [(100, [1.0], 1), (101, [0.9], 1), (102, [0.5], 2)]])
def test_few_rows(spark, rows):
    assert mined(table(spark, rows), clusters=2, segments=2) == brute(rows, 5, 10)


def test_sql(spark):
    rows = PLAIN[:300] + PLAIN[100:102] + [(None, [0.5] * 6, 2), (200, None, 1), (300, [float("nan")] * 6, 1)]
    con = duckdb.connect()
    con.register("embeddings", table(spark, rows).select("vec_id", "embedding", "label").toArrow())
    got = Counter(tuple(NULL if x is None else x for x in r) for r in con.execute(oracle_sql.hard_negatives()).fetchall())
    assert {k[:2] + k[3:]: 1 for k in got} == {k[:2] + k[3:]: 1 for k in brute([(i, None if v is None else v, lab) for i, v, lab in rows], 5, 10)}


def test_walks_end_early_where_bounds_allow(spark):
    rng = np.random.default_rng(5)
    middles = np.eye(8) * 4
    rows = [(i, (middles[i % 8] + rng.normal(size=8) * 0.1).tolist(), i % 3) for i in range(800)]
    found = hard_negatives(table(spark, rows), F.col("vec_id") % 100 == 0, positives=2, negatives=3, window=(30, 100), clusters=8, segments=4, with_walk=True).collect()
    assert found and max(r.walked for r in found) < 4


def test_bounds_hold_and_segments_follow_them():
    rng = np.random.default_rng(6)
    x, anchors = rng.normal(size=(500, 5)) * rng.lognormal(size=(500, 1)) * 100, rng.normal(size=(200, 5)) * 100
    x[0] = anchors[0] = 0
    centres = spherical_centres(anchors, 4)
    angle, norm = Lists.angles(anchors, centres)
    near = angle.argmin(1)
    radius = np.array([angle[near == c, c].max(initial=0) for c in range(len(centres))])
    lists = Lists(centres, radius, np.zeros((len(centres), 0)))
    bound = lists.bounds(x)
    lists.floors = np.quantile(bound, [0.9, 0.5], axis=0).T
    for a, c, n in zip(anchors, near, norm):
        assert (x @ a <= n * bound[:, c] + 1e-6).all()
    segment = lists.segments(x, np.arange(len(centres)))
    for c in range(len(centres)):
        assert (bound[segment[:, c] > 0, c] < lists.floors[c, 0]).all() and (bound[segment[:, c] < 2, c] >= lists.floors[c, 1]).all()


def test_leading():
    group, score, ids, row = (np.array(c) for c in ([1, 1, 1, 0, 1], [5, 7, 7, -3, 1], [1, 9, 2, 4, 0], [0, 1, 2, 3, 4]))
    assert sorted(leading(group, score, ids, row, 2).tolist()) == [1, 2, 3]
