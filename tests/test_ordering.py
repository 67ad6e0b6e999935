"""Distributed order statistics against numpy / sorted Python on skewed data."""

import numpy as np

from txnguard.functions import exact_quantiles, global_rank


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=700), np.full(400, 2.5), rng.integers(0, 5, 300)]).astype(float)
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, "x", probs).first()
    want = np.percentile(vals, [p * 100 for p in probs])
    for i, w in enumerate(want):
        assert abs(got[f"q{i}"] - w) < 1e-9


def test_exact_quantiles_single_value_and_empty(spark):
    one = spark.createDataFrame([(7.0,)] * 5, "x double")
    r = exact_quantiles(one, "x", [0.25, 0.75]).first()
    assert (r.q0, r.q1) == (7.0, 7.0)
    empty = spark.createDataFrame([], "x double")
    r = exact_quantiles(empty, "x", [0.5]).first()
    assert r.q0 is None


def test_global_rank(spark):
    words = ["pear", "apple", "fig", "apple", "kiwi", "fig", "zucchini"] * 30
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.code for r in global_rank(df, "w").collect()}
    assert got == {w: i for i, w in enumerate(sorted(set(words)))}


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=60),
    st.lists(st.floats(min_value=0, max_value=1), min_size=1, max_size=4),
)
def test_exact_quantiles_property(spark, values, probs):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_quantiles(df, "x", probs).first()
    want = np.percentile(np.array(values, dtype=float), [p * 100 for p in probs])
    for i, w in enumerate(want):
        assert abs(got[f"q{i}"] - w) < 1e-9
