"""A customer holding a third of all rows: results equal brute force."""

import datetime as dt
import random

import pandas as pd

from txnguard.operators import extensions, views


def _skewed(spark, n=900):
    rnd = random.Random(9)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        cust = "HOT" if i % 3 == 0 else f"C{rnd.randint(1, 40)}"
        ts = base + dt.timedelta(seconds=rnd.randint(0, 30 * 86400))
        rows.append((f"X{i}", ts.strftime("%Y-%m-%d %H:%M:%S"), cust, round(rnd.uniform(1, 500), 2), int(rnd.random() < 0.1)))
    return spark.createDataFrame(rows, "transaction_id string, post_ts string, customer_id string, amt double, fraud int"), rows


def test_customer_risk_with_hot_key(spark):
    df, rows = _skewed(spark)
    pdf = pd.DataFrame(rows, columns=["transaction_id", "post_ts", "customer_id", "amt", "fraud"])
    want = pdf.groupby("customer_id").agg(n=("amt", "size"), f=("fraud", "sum"), s=("amt", "sum"))
    got = {r.customer_id: r for r in views.customer_risk(df).collect()}
    assert set(got) == set(want.index)
    for c, w in want.iterrows():
        assert got[c].total_transactions == w.n and got[c].fraudulent_transactions == w.f
        assert abs(got[c].total_amount - w.s) < 1e-6


def test_rolling_stats_with_hot_key(spark):
    df, rows = _skewed(spark)
    pdf = pd.DataFrame(rows, columns=["transaction_id", "post_ts", "customer_id", "amt", "fraud"])
    pdf["t"] = pd.to_datetime(pdf.post_ts).astype("int64") // 10**9
    got = {r.transaction_id: (r.rolling_count, r.rolling_mean_amount)
           for r in extensions.rolling_customer_stats(df, window_days=7).collect()}
    assert len(got) == len(pdf)
    span = 7 * 86400
    for _, r in pdf.sample(150, random_state=1).iterrows():
        same = pdf[(pdf.customer_id == r.customer_id) & (pdf.t <= r.t) & (pdf.t > r.t - span)]
        cnt, mean = got[r.transaction_id]
        assert cnt == len(same) and abs(mean - same.amt.mean()) < 1e-9
