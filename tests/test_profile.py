"""Profiling operators against numpy."""

import math

import numpy as np

from txnguard.operators import profile


def test_density_close_to_exact_kde(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(0, 1, 3000), rng.normal(5, 0.5, 1000)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = sorted((r.g, r.x, r.density) for r in profile.density(df, "x").collect())
    n, h = len(x), x.std(ddof=1) * len(x) ** -0.2
    for g, gx, d in got[::20]:
        exact = np.exp(-0.5 * ((gx - x) / h) ** 2).sum() / (n * h * math.sqrt(2 * math.pi))
        assert abs(d - exact) < 2e-3 * max(exact, 1e-3) + 1e-4
    assert len(got) == 200
    grid = [gx for _, gx, _ in got]
    assert abs(grid[0] - (x.min() - 3 * h)) < 1e-9 and abs(grid[-1] - (x.max() + 3 * h)) < 1e-9


def test_remove_outliers_matches_numpy(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.lognormal(3, 1, 2000), [0.0, -4.0, 1e6]])
    df = spark.createDataFrame([(float(v),) for v in x], "amt double")
    q1, q3 = np.percentile(x, [25, 75])
    keep = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    keep = keep[keep > 0]
    got = sorted(r.amt for r in profile.remove_outliers(df, "amt").collect())
    assert got == sorted(keep.tolist())


def test_value_counts_shares(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1), (None, 0)], "t string, f int")
    got = {(r.column, r.value): (r["count"], r.share) for r in profile.value_counts(df, ["t", "f"]).collect()}
    assert got[("t", "a")] == (2, 2 / 3) and got[("f", "1")] == (2, 2 / 3) and ("t", None) not in got


def test_missing_counts_nan(spark):
    df = spark.createDataFrame([(float("nan"), None), (1.0, "x")], "a double, b string")
    assert {r.column: r.missing for r in profile.missing(df).collect()} == {"a": 1, "b": 1}


def test_nan_is_missing_everywhere(spark):
    import math

    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (None,)], "x double")
    r = profile.describe(df, "x").first()
    assert (r["count"], r["mean"], r["max"], r["p50"]) == (3, 2.0, 3.0, 2.0)
    assert profile.missing(df).first()["missing"] == 2
    assert {x["value"] for x in profile.value_counts(df, ["x"]).collect()} == {"1.0", "2.0", "3.0"}
    assert all(not math.isnan(x["density"]) for x in profile.density(df, "x").collect())


def test_density_of_no_spread_is_empty(spark):
    for rows in ([(2.0,)] * 5, [(1.0,)], []):
        assert profile.density(spark.createDataFrame(rows, "x double"), "x").count() == 0


def test_density_is_close_to_the_unbinned_sum(spark):
    import math
    import random

    rng = random.Random(0)
    xs = [rng.gauss(0, 1) if rng.random() < 0.7 else rng.gauss(6, 0.5) for _ in range(2000)]
    got = profile.density(spark.createDataFrame([(x,) for x in xs], "x double"), "x").collect()
    n, mean = len(xs), sum(xs) / len(xs)
    h = math.sqrt(sum((x - mean) ** 2 for x in xs) / (n - 1)) * n**-0.2
    for r in got:
        want = sum(math.exp(-0.5 * ((r["x"] - x) / h) ** 2) for x in xs) / (n * h * math.sqrt(2 * math.pi))
        assert abs(r["density"] - want) < 5e-4 * max(want, 0.1)


def test_exact_quantiles_narrow_in_several_passes(spark, monkeypatch):
    import random

    import numpy as np

    from txnguard.functions import ordering

    monkeypatch.setattr(ordering, "ACCURACY", 50)
    monkeypatch.setattr(ordering, "FEW", 20)
    rng = random.Random(1)
    for xs in ([rng.lognormvariate(0, 3) for _ in range(5000)], [1.0] * 3000 + [rng.random() * 2 for _ in range(2000)], [float(i % 3) for i in range(4000)]):
        probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
        got = ordering.exact_quantiles(spark.createDataFrame([(x,) for x in xs], "x double"), "x", probs).first()
        assert np.allclose(list(got), np.quantile(xs, probs), rtol=1e-12)


def test_category_codes_beyond_the_read_limit(spark, monkeypatch):
    from txnguard.operators import encode

    df = spark.createDataFrame([(v,) for v in ["b", "a", None, "é", "Z", "a", "zz"]], "t string")
    few = sorted(map(str, encode.category_codes(df, "t").collect()))
    monkeypatch.setattr(encode, "MAX_CODES", 2)
    assert sorted(map(str, encode.category_codes(df, "t").collect())) == few
