"""Plan properties from SURVEY §4: pruning, pushdown, no Python in hot paths,
partial aggregation before the shuffle."""

from txnguard import adapters
from txnguard.operators import ml, serving, views
from txnguard.specs import TRANSFERS
from txnguard.streaming import score as st


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_agg1_prunes_and_aggregates_partially(spark, sf):
    p = _plan(views.fraud_by_type(adapters.transfers(spark, sf)))
    assert "partial_count" in p and "partial_avg" in p
    assert "o_orderdate" not in p  # pruned: the view never reads it


def test_lookup_pushes_filter(spark, sf):
    df = serving.lookup(spark.read.parquet(f"{sf}/customer.parquet"), "c_mktsegment", "BUILDING")
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in _plan(df)


def test_scoring_has_no_python_udf(spark, sf):
    feats = ml.features_for(adapters.transfers(spark, sf), TRANSFERS)
    model = ml.train(feats.select("features", "fraud"), "fraud", 1)
    scored = st.project_transfers(model.transform(feats.withColumn("record_id", feats["transaction_id"])))
    p = _plan(scored)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_parallel_refresh_equals_sequential(spark, sf):
    from txnguard.session import scratch_path
    from txnguard.sinks.views import read_view

    srcs = {"dataset1": adapters.transfers(spark, sf), "dataset3": adapters.card_transactions(spark, sf)}
    a, b = scratch_path(spark, "par"), scratch_path(spark, "seq")
    views.refresh(spark, srcs, a, parallel=True)
    views.refresh(spark, srcs, b, parallel=False)
    for v in views.VIEWS:
        ra = sorted(map(tuple, read_view(spark, a, v).collect()), key=str)
        rb = sorted(map(tuple, read_view(spark, b, v).collect()), key=str)
        assert ra == rb, v
