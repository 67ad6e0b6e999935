"""The jobs one after another over catalog tables: ingest, batch, train, speed,
retrain, speed; and publishing under readers and other writers."""


import os
import threading

import pytest
from pyspark.sql import functions as F

from txnguard import adapters, jobs
from txnguard.operators import ingest, ml
from txnguard.operators.retrain import retrain
from txnguard.session import scratch_path
from txnguard.sinks import views as v
from txnguard.sources.models import latest_versions
from txnguard.specs import CARD_TRANSACTIONS

LOADERS = {"model1": adapters.transfers, "model2": adapters.card_behaviour, "model3": adapters.card_transactions}


def test_ingest_batch_train_speed_retrain_speed(spark, sf):
    base = scratch_path(spark, "flow")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS flow_test LOCATION '{base}/flow_test.db'")  # not where an earlier run left tables
    for i, (name, spec) in enumerate(jobs.MODEL_SPECS.items(), 1):
        records = ingest.encode_json(LOADERS[name](spark, sf, tags=True), spec)
        records.unionByName(spark.createDataFrame([("broken",)], "value string")).write.text(os.path.join(base, f"in{i}"))
        landed = os.path.join(base, f"landed{i}")
        jobs.ingest_stream(spark, name, {"kind": "files", "path": os.path.join(base, f"in{i}")}, landed, os.path.join(base, f"ck{i}"), available_now=True).awaitTermination()
        got = spark.read.parquet(landed)
        assert got.where("quality = 'valid'").count() == records.count() and got.where("quality = 'quarantine'").count() == 1
        ingest.conform(got.where("quality = 'valid'"), spec).drop("quality", "reason", "_raw").write.mode("overwrite").saveAsTable(f"flow_test.dataset{i}")
    out = os.path.join(base, "views")
    assert len(jobs.batch_refresh(spark, out, "flow_test")) == 4
    models = os.path.join(base, "models")
    assert set(jobs.train_all(spark, models, "flow_test", version="20250101_000000")["paths"]) == set(jobs.MODEL_SPECS)
    sources = {n: {"kind": "files", "path": os.path.join(base, f"in{i}")} for i, n in enumerate(jobs.MODEL_SPECS, 1)}
    for run in ("one", "two"):
        jobs.speed_layer(spark, models, sources, os.path.join(base, run), os.path.join(base, f"ck-{run}"), available_now=True)
        assert not spark.streams.active
        for name, spec in jobs.MODEL_SPECS.items():
            n = LOADERS[name](spark, sf).count()
            assert spark.read.parquet(os.path.join(base, run, f"predictions_{spec.name}")).count() == n
            assert spark.read.parquet(os.path.join(base, run, f"quarantine_{spec.name}")).count() == 1
        retrain(spark, spark.table("flow_test.dataset1"), models, os.path.join(base, "metrics"), version="20250202_000000")
        assert latest_versions(spark, models) == {"model1": "20250202_000000", "model2": "20250101_000000", "model3": "20250101_000000"}


def test_batch_that_publishes_nothing_fails(spark, tmp_path, capsys):
    assert jobs.main(["--no-hive", "batch", "--out", str(tmp_path), "--database", "no_such_database"]) == 1
    with pytest.raises(RuntimeError):
        jobs.train_all(spark, str(tmp_path), "no_such_database")


def test_retrain_without_an_id_column(spark, sf):
    base = scratch_path(spark, "retrain2")
    df = adapters.card_behaviour(spark, sf)
    done = retrain(spark, df, base, os.path.join(base, "metrics"), name="model2", spec=jobs.MODEL_SPECS["model2"])
    assert os.path.basename(os.path.dirname(done["path"])).startswith("model2_")


def test_split_csv(spark, sf, tmp_path):
    df = adapters.card_transactions(spark, sf)
    df.write.option("header", True).csv(str(tmp_path / "in"))
    done = jobs.split_csv(spark, {"d3": str(tmp_path / "in")}, str(tmp_path / "out"), {"d3": ["transaction_id"]})
    parts = [spark.read.option("header", True).csv(done[f"d3_{p}"]) for p in ("train", "test")]
    assert parts[0].count() + parts[1].count() == df.count() and parts[0].join(parts[1], "transaction_id").count() == 0


def test_readers_and_writers_during_publish(spark):
    out = scratch_path(spark, "publish")
    frames = [spark.range(10).withColumn("w", F.lit(k)) for k in range(2)]
    v.replace_view(spark, frames[0], out, "x")
    seen, failed = [], []

    def write(k):
        for _ in range(4):
            v.replace_view(spark, frames[k], out, "x")

    def read():
        for _ in range(15):
            got = v.read_view(spark, out, "x")
            (seen if got is not None and got.count() == 10 and got.select("w").distinct().count() == 1 else failed).append(1)

    threads = [threading.Thread(target=write, args=(k,)) for k in (0, 1)] + [threading.Thread(target=read)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(seen) == 15 and not failed
    assert v.expire_versions(spark, out, "x", 3600) == []
    assert len(v.expire_versions(spark, out, "x", -60)) == 8 and v.read_view(spark, out, "x").count() == 10


def test_model_does_not_depend_on_input_partitions(spark, sf):
    feats = ml.features_for(adapters.card_transactions(spark, sf), CARD_TRANSACTIONS).select("features", "fraud")
    scores = []
    for n in (2, 8):
        model = ml.train(feats.repartition(n), "fraud", 42)
        scored = ml.with_fraud_probability(model.transform(feats)).select(F.get(ml.vector_to_array("features"), 0).alias("x"), "fraud_probability")
        scores.append(sorted(map(tuple, scored.distinct().collect())))
    assert scores[0] == scores[1]


def test_splits_do_not_shuffle_rows_on_the_label(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = adapters.card_behaviour(spark, sf, tags=True)
        for part in (*ml.stratified_split(df, ["l_orderkey"], "fraud", 0.8, 1), ml.balanced_weights(df, "fraud")):
            assert "hashpartitioning(fraud" not in part._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_checkpoint_folder_must_be_shared_off_local():
    from txnguard import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
