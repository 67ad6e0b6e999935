"""Spark ML: seeded repeatability, probability range, single-class refusal,
version lookup with incomplete sets, metrics on empty denominators."""

import pytest
from pyspark.sql import functions as F

from txnguard import adapters
from txnguard.operators import ml
from txnguard.session import scratch_path
from txnguard.sinks.models import save
from txnguard.sources.models import latest_complete_version, load_latest
from txnguard.specs import CARD_BEHAVIOUR


@pytest.fixture(scope="module")
def feats(spark, sf):
    return ml.features_for(adapters.card_behaviour(spark, sf, tags=True), CARD_BEHAVIOUR).cache()


def test_seeded_forest_repeatable(feats):
    a = ml.train(feats.select("features", "fraud"), "fraud", 7)
    b = ml.train(feats.select("features", "fraud"), "fraud", 7)
    pa = [r.prediction for r in ml.score(a, feats).orderBy("l_orderkey", "l_linenumber").collect()]
    pb = [r.prediction for r in ml.score(b, feats).orderBy("l_orderkey", "l_linenumber").collect()]
    assert pa == pb


def test_probability_range_and_quality(feats):
    tr, te = ml.split(feats, ["l_orderkey", "l_linenumber"], 0.7, 42)
    m = ml.train(tr.select("features", "fraud"), "fraud", 42)
    p = ml.with_fraud_probability(ml.score(m, te))
    r = p.agg(F.min("fraud_probability").alias("lo"), F.max("fraud_probability").alias("hi")).first()
    assert 0.0 <= r.lo <= r.hi <= 1.0
    met = ml.metrics(p, "fraud").first()
    assert met.accuracy > 0.9


def test_single_class_rejected(spark, feats):
    with pytest.raises(ValueError):
        ml.train(feats.where(F.col("fraud") == 0).select("features", "fraud"), "fraud", 1)


def test_stratified_split_keeps_shares(feats):
    tr, te = ml.stratified_split(feats, ["l_orderkey", "l_linenumber"], "fraud", 0.8, 2025)
    for cls in (0, 1):
        n_tr = tr.where(F.col("fraud") == cls).count()
        n_te = te.where(F.col("fraud") == cls).count()
        assert abs(n_tr / (n_tr + n_te) - 0.8) < 0.05


def test_metrics_empty_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "fraud int, prediction int")
    r = ml.metrics(df).first()
    assert (r.precision, r.recall, r.accuracy) == (0.0, 0.0, 1.0)


def test_latest_complete_version(spark, feats):
    base = scratch_path(spark, "models-test")
    m = ml.train(feats.select("features", "fraud"), "fraud", 1)
    for name in ("model1", "model2", "model3"):
        save(m, base, name, "20250101_101010")
    save(m, base, "model1", "20250202_000000")  # incomplete newer version
    assert latest_complete_version(spark, base) == "20250101_101010"
    version, models = load_latest(spark, base)
    assert version == "20250101_101010" and set(models) == {"model1", "model2", "model3"}
    assert load_latest(spark, scratch_path(spark, "empty")) is None


def test_layout_follows_the_rows(spark, feats):
    assert [ml.layout_partitions(n) for n in (0, 10, 4_000_000, 4_000_001, 10**11)] == [8, 8, 8, 9, 200_000]
    rows = feats.select("features", "fraud")
    assert ml.training_layout(rows).rdd.getNumPartitions() == 8 and ml.training_layout(rows, 3).rdd.getNumPartitions() == 3
    few = [ml.train(rows.repartition(n), "fraud", 7, partitions=3).stages[-1].toDebugString for n in (2, 5)]
    assert few[0].split("\n", 1)[1] == few[1].split("\n", 1)[1]


def test_floors_reject_the_majority_class(spark):
    from txnguard.plans.q_ml import FLOORS, _balanced

    rows = [(d, m, 0, 0, 70, 930, 0.93, 0.0, 0.0, 0.9) for d, m in FLOORS]
    names = "dataset string, model string, tp long, fp long, fn long, tn long, accuracy double, precision double, recall double, f1_weighted double"
    assert not any(r.balanced_ok for r in _balanced(spark.createDataFrame(rows, names)).collect())


def test_boosting_on_cells_is_boosting_on_rows(spark):
    rows = spark.range(3000).selectExpr(
        "CAST(pmod(xxhash64(id), 40) AS DOUBLE) AS many", "CAST(pmod(xxhash64(id, 1), 3) AS DOUBLE) AS few",
        "pmod(xxhash64(id, 2), 100000) / 7.0 AS wide", "0.0 AS same", "CAST(pmod(xxhash64(id, 3), 2) AS DOUBLE) AS flag",
    ).withColumn("fraud", F.expr("CAST(many > 21 AND wide < 6000 OR flag = 1 AND few = 2 AS INT)"))
    feats = ["many", "few", "wide", "same", "flag"]
    te, out = rows.withColumn("wide", F.col("wide") + 3), []
    on_rows = ml.train(ml.assemble(rows, feats).select("features", "fraud"), "fraud", 5, "gradient_boosting", gbt_iter=4)
    for scored in (ml.score(on_rows, ml.assemble(te, feats)), ml.boost_cells(rows, te, feats, "fraud", 5, gbt_iter=4)):
        out.append(sorted((r.fraud, r.prediction, round(r.p, 6)) for r in ml.with_fraud_probability(scored, "p").select("fraud", "prediction", "p").collect()))
    assert out[0] == out[1] and len(set(out[0])) > 5


def test_comparison_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(2000).selectExpr("id", "CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b", "CAST(id % 17 > 11 AS INT) AS fraud")
    rows = rows.mapInArrow(count, rows.schema)
    got = ml.compare([("d", rows, ["a", "b"], "fraud")], ["naive_bayes", "gradient_boosting", "linear_svm"], 1, key_cols=["id"], gbt_iter=2)
    assert got.count() == 3 and seen.value == 2000


def test_deep_forest_keeps_each_rows_node(spark):
    rows = spark.range(600).selectExpr("CAST(id % 37 AS DOUBLE) AS a", "CAST(id % 11 AS DOUBLE) AS b", "CAST(hash(id) % 3 = 0 AS INT) AS fraud")
    laid = ml.assemble(ml.training_layout(rows), ["a", "b"]).cache()
    deep = ml.estimator("random_forest_deep", "fraud", 5)
    assert deep.getCacheNodeIds()
    assert deep.fit(laid).toDebugString.split("\n")[1:] == deep.copy({deep.cacheNodeIds: False}).fit(laid).toDebugString.split("\n")[1:]


def test_forest_on_cells_is_a_forest_on_rows(spark):
    rows = spark.range(20_000).selectExpr(
        "id", "CAST(pmod(xxhash64(id), 50) AS FLOAT) AS many", "CAST(pmod(xxhash64(id, 1), 3) AS INT) AS few", "CAST(0 AS DOUBLE) AS same"
    ).withColumn("fraud", F.expr("CAST(many > 40 AND few = 2 OR pmod(xxhash64(id, 2), 50) = 0 AS INT)"))
    feats = ["many", "few", "same"]
    args = [("d", rows, feats, "fraud")], ["random_forest_deep"], 3
    on_cells, on_rows = (ml.compare(*args, key_cols=["id"], cell_rows=n).first() for n in (0, 10**9))
    assert on_cells.tp + on_cells.fn == on_rows.tp + on_rows.fn and on_cells.tn + on_cells.fp == on_rows.tn + on_rows.fp
    assert abs(on_cells.tp - on_rows.tp) <= 0.03 * on_rows.tp and abs(on_cells.fp - on_rows.fp) <= 20
    assert ml.compare(*args, key_cols=["id"], cell_rows=0).first() == on_cells

    # Copies are drawn by rows: their number in a cell varies as a sum of as many Poisson(1).
    laid = ml.training_layout(rows.select(*feats, "fraud"))
    counts, n = ml.value_counts(laid, feats)
    assert n == 20_000 and len(counts[0]) == 50 and sum(counts[1].values()) == n
    edges = ml._edges_of(counts, n, ml.BINS, ml.FINE_VALUES)
    got = ml.cells(laid, feats, "fraud", edges, 10, 7).collect()
    assert [len(e) for e in edges] == [49, 2, 0] and sum(r.weight for r in got) == n and len(got) == rows.select(*feats, "fraud").distinct().count()
    z = [(r[f"copies{i}"] - r.weight) / r.weight**0.5 for r in got for i in range(10) if r.weight > 20]
    assert abs(sum(z) / len(z)) < 0.15 and 0.85 < sum(x * x for x in z) / len(z) < 1.15


def test_models_on_rows_are_scored_in_one_pass(spark):
    rows = spark.range(3000).selectExpr("id", "CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 5 AS INT) AS b", "CAST(hash(id) % 4 = 0 OR id % 17 > 11 AS INT) AS fraud")
    kinds, feats = ["naive_bayes", "gradient_boosting", "logistic_regression", "random_forest_deep"], ["a", "b"]
    got = {r.model: r for r in ml.compare([("d", rows, feats, "fraud")], kinds, 1, key_cols=["id"], gbt_iter=2).collect()}
    tr, te = ml.stratified_split(rows, ["id"], "fraud", 0.8, 1)
    plain = [F.col(f).cast("double").alias(f) for f in feats]
    laid = ml.training_layout(tr.select(*plain, "fraud"))
    for kind in kinds:
        one = {"gbt_iter": 2} if kind == "gradient_boosting" else {}
        model = ml.fit(ml.assemble(laid, feats), "fraud", 1, kind, **one)
        alone = ml.metrics(ml.score(model, ml.assemble(te.select(*plain, "fraud"), feats))).first()
        assert got[kind][2:] == tuple(alone), kind
    assert list(got) == kinds
