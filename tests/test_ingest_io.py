"""Decode, validation, conformance, file sources/sinks and the view refresh."""

import os

from pyspark.sql import functions as F

from txnguard import adapters
from txnguard.operators import ingest, views
from txnguard.session import scratch_path
from txnguard.sinks.files import write_arff
from txnguard.sinks.views import current_path, read_view
from txnguard.sources.files import read_arff, read_table
from txnguard.specs import CARD_TRANSACTIONS, TRANSFERS


def test_decode_permissive(spark):
    recs = spark.createDataFrame(
        [("not json",), ('{"bin":"123456","amt":1.5,"customer_id":"C1"}',), ('{"amount":"10","step":3}',)], "value string"
    )
    ct = ingest.decode(recs, CARD_TRANSACTIONS).collect()
    assert all(v is None for k, v in ct[0].asDict().items() if k != "_raw")
    assert ct[1].bin is None and ct[1].amt == 1.5 and ct[1].customer_id == "C1"
    t = ingest.decode(recs, TRANSFERS).collect()
    assert t[2].amount is None and t[2].step == 3


def test_validate_partitions_input(spark):
    recs = spark.createDataFrame(
        [('{"step":1,"type":"PAYMENT","amount":5.0,"nameOrig":"C1","oldbalanceOrg":9.0,"isFraud":0}',),
         ("not json",),
         ('{"step":"step","type":"type","amount":"amount","nameOrig":"nameOrig","oldbalanceOrg":"x","isFraud":"isFraud"}',),
         ('{"step":2,"type":"PAYMENT","nameOrig":"C2","oldbalanceOrg":1.0,"isFraud":0}',)],
        "value string",
    )
    good, bad = ingest.validate(ingest.decode(recs, TRANSFERS), TRANSFERS)
    assert good.count() == 1 and bad.count() == 3
    reasons = {r.reason for r in bad.collect()}
    assert "missing:amount" in reasons


def test_conform_coerces(spark):
    df = spark.createDataFrame([("1.5", "x", "7")], "amt string, bin string, fraud string")
    r = ingest.conform(df, CARD_TRANSACTIONS, keep_extra=False).first()
    assert r.amt == 1.5 and r.bin is None and r.fraud == 7 and r.customer_id is None


def test_tag(spark):
    df = spark.createDataFrame([("2024-03-05 07:09:00",)], "s string").select(F.to_timestamp("s").alias("ts"))
    r = ingest.tag(df, "ts").first()
    assert (r.year, r.month, r.day, r.hour, r.minute) == ("2024", "03", "05", "7", "9")


def test_arff_roundtrip_quotes_and_missing(spark):
    path = scratch_path(spark, "arff-test")
    lines = ["% comment", "@relation r", "@attribute x numeric", "@attribute 'label name' {yes,no}",
             "@data", "1.5,yes", "?,'no'"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    df = read_arff(spark, path)
    assert df.columns == ["x", "label name"]
    assert [tuple(r) for r in df.collect()] == [(1.5, "yes"), (None, "no")]
    out = scratch_path(spark, "arff-write")
    write_arff(spark.createDataFrame([(1.0, 2), (3.5, None)], "a double, b int"), out, "t")
    back = read_arff(spark, os.path.join(out, "*")).orderBy("a").collect()
    assert [tuple(r) for r in back] == [(1.0, 2.0), (3.5, None)]


def test_refresh_atomic_and_skips_missing(spark, sf):
    out = scratch_path(spark, "views-test")
    t = adapters.transfers(spark, sf)
    published = views.refresh(spark, {"dataset1": t, "dataset3": None}, out)
    assert set(published) == {"fraud_by_transaction_type", "fraud_by_amount_bucket"}
    first = current_path(spark, out, "fraud_by_transaction_type")
    direct = {r.type: r.total_transactions for r in views.fraud_by_type(t).collect()}
    got = {r.type: r.total_transactions for r in read_view(spark, out, "fraud_by_transaction_type").collect()}
    assert got == direct
    views.refresh(spark, {"dataset1": t}, out)
    assert current_path(spark, out, "fraud_by_transaction_type") != first
    assert read_view(spark, out, "hourly_fraud_stats") is None


def test_read_table_missing(spark):
    assert read_table(spark, "no_such_table_xyz") is None


def test_land_layout_with_quality(spark, sf):
    from txnguard.sinks.files import land

    recs = spark.createDataFrame(
        [('{"year":"2024","month":"01","day":"02","step":1,"type":"PAYMENT","amount":5.0,"nameOrig":"C1","oldbalanceOrg":9.0,"isFraud":0}',),
         ('{"year":"2024","month":"01","day":"03","step":2}',)],
        "value string",
    )
    path = scratch_path(spark, "land-test")
    land(ingest.mark(ingest.decode(recs, TRANSFERS), TRANSFERS), path, by_quality=True)
    from txnguard.sources.files import read_landed

    got = read_landed(spark, path, TRANSFERS)
    rows = {(r.quality, r.year, r.month, r.day) for r in got.select("quality", "year", "month", "day").collect()}
    assert rows == {("valid", "2024", "01", "02"), ("quarantine", "2024", "01", "03")}
    assert got.where("quality = 'quarantine'").first().reason.startswith("missing:")


def test_batch_refresh_job_over_catalog(spark, sf):
    from txnguard.jobs import batch_refresh
    from txnguard.plans.q_batch import _land_to_catalog

    _land_to_catalog(spark, sf, "fraud_test")
    out = scratch_path(spark, "views-job")
    published = batch_refresh(spark, out, "fraud_test")
    assert set(published) == set(views.VIEWS)
    n = read_view(spark, out, "high_risk_customers").agg({"total_transactions": "sum"}).first()[0]
    assert n == adapters.card_transactions(spark, sf).count()
    spark.sql("DROP TABLE fraud_test.dataset3")
    again = batch_refresh(spark, scratch_path(spark, "views-job2"), "fraud_test")
    assert set(again) == {"fraud_by_transaction_type", "fraud_by_amount_bucket"}
