"""AGG-5 by date range, and partitions in the catalog."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from txnguard import adapters, jobs
from txnguard.operators import ingest, views
from txnguard.session import scratch_path
from txnguard.sinks.files import land
from txnguard.sinks.views import read_view
from txnguard.sources.files import partition_values, read_partitioned, register_partitioned_table, register_partitions
from txnguard.specs import CARD_TRANSACTIONS, TRANSFERS


def landed(spark, sf):
    spec = CARD_TRANSACTIONS
    cols = [n for n, _ in spec.columns] + ["year", "month", "day"]
    day = F.lpad((F.crc32("transaction_id") % 9 + 1).cast("string"), 2, "0")
    return ingest.conform(adapters.card_transactions(spark, sf, tags=True).withColumns({"year": F.lit("2024"), "month": F.lit("05"), "day": day}), spec).select(*cols)


def rounded(df):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_random_changes_equal_the_full_refresh(spark, sf):
    rng, path, out = random.Random(4), scratch_path(spark, "days"), scratch_path(spark, "views")
    rows = landed(spark, sf).cache()
    land(rows.where("day <= '06'"), path)
    load = lambda: read_partitioned(spark, path, CARD_TRANSACTIONS)
    assert len(views.refresh_days(spark, {"dataset3": load}, out)) == 2
    for step in range(3):
        days = sorted(rng.sample([f"2024-05-{d:02d}" for d in range(1, 10)], 3))
        changed = rows.where(views.day_of().isin(days)).withColumn("amt", (F.col("amt") + step).cast("float")).sample(0.7, seed=step)
        with_some = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            land(changed, path, mode="overwrite")
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", with_some)
        views.refresh_days(spark, {"dataset3": load}, out, days)
        full = scratch_path(spark, "views-full")
        views.refresh(spark, {"dataset3": load}, full)
        for view in ("hourly_fraud_stats", "high_risk_customers"):
            assert rounded(read_view(spark, out, view)) == rounded(read_view(spark, full, view))
    rows.unpersist()


def test_only_changed_days_are_read(spark, sf):
    path, out = scratch_path(spark, "days-pruned"), scratch_path(spark, "views")
    rows = landed(spark, sf)
    land(rows, path)
    load = lambda: read_partitioned(spark, path, CARD_TRANSACTIONS)
    views.refresh_days(spark, {"dataset3": load}, out)
    before = rounded(read_view(spark, out, "hourly_fraud_stats"))
    with open(os.path.join(path.removeprefix("file:"), "year=2024", "month=05", "day=03", "part-broken.snappy.parquet"), "wb") as f:
        f.write(b"not parquet")
    views.refresh_days(spark, {"dataset3": load}, out, ["2024-05-01", "2024-05-02"])
    assert rounded(read_view(spark, out, "hourly_fraud_stats")) == before
    with pytest.raises(Exception):
        views.refresh_days(spark, {"dataset3": load}, out, ["2024-05-03"])
    assert rounded(read_view(spark, out, "hourly_fraud_stats")) == before


def test_days_without_rows_and_rows_without_a_day(spark, sf):
    path, out = scratch_path(spark, "days-odd"), scratch_path(spark, "views")
    rows = landed(spark, sf)
    land(rows.where("day = '01'").withColumn("day", F.lit(None).cast("string")).unionByName(rows.where("day = '02'")), path)
    load = lambda: read_partitioned(spark, path, CARD_TRANSACTIONS)
    assert views.refresh_days(spark, {"dataset1": None, "dataset3": load}, out)
    n = rows.where("day <= '02'").count()
    assert read_view(spark, out, "hourly_fraud_stats").agg(F.sum("total_transactions")).first()[0] == n
    some = rows.where("day = '02'")
    views.refresh_days(spark, {"dataset3": some}, out)  # now without the rows that had no day
    assert read_view(spark, out, "hourly_fraud_stats").agg(F.sum("total_transactions")).first()[0] == some.count()
    views.refresh_days(spark, {"dataset3": rows.where("false")}, out, ["2024-05-02"])
    assert read_view(spark, out, "hourly_fraud_stats").count() == 0


def test_job_since(spark, sf):
    spark.sql("CREATE DATABASE IF NOT EXISTS since_test")
    path, out = scratch_path(spark, "since"), scratch_path(spark, "views")
    rows = landed(spark, sf)
    land(rows.where("day < '05'"), path)
    register_partitioned_table(spark, "dataset3", path, CARD_TRANSACTIONS, "since_test")
    assert len(jobs.batch_refresh(spark, out, "since_test", since="2000-01-01 00:00:00")) == 2
    time.sleep(1.1)
    mark = spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0]
    time.sleep(1.1)
    more = rows.where("day >= '08'")
    land(more, path)
    register_partitions(spark, "dataset3", CARD_TRANSACTIONS, partition_values(more, CARD_TRANSACTIONS), "since_test")
    spark.catalog.refreshTable("since_test.dataset3")
    assert views.changed_days(spark.table("since_test.dataset3"), mark) == ["2024-05-08", "2024-05-09"]
    assert len(jobs.batch_refresh(spark, out, "since_test", since=mark)) == 2
    want = rows.where("day < '05' OR day >= '08'").count()
    assert read_view(spark, out, "high_risk_customers").agg(F.sum("total_transactions")).first()[0] == want
    spark.sql("DROP DATABASE since_test CASCADE")


def test_existing_table_keeps_its_properties(spark, sf):
    path = scratch_path(spark, "registered")
    cols = [n for n, _ in TRANSFERS.columns] + ["year", "month", "day"]
    rows = ingest.conform(adapters.transfers(spark, sf, tags=True), TRANSFERS).select(*cols)
    land(rows.where("day <= '02'"), path)
    name = "registered_test"
    first = register_partitioned_table(spark, name, path, TRANSFERS).count()
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('kept_by' = 'me')")
    more = rows.where("day = '03'")
    land(more, path)
    t = register_partitioned_table(spark, name, path, TRANSFERS, parts=partition_values(more, TRANSFERS))
    assert t.count() == first + more.count() == rows.where("day <= '03'").count()
    assert spark.sql(f"SHOW TBLPROPERTIES {name} ('kept_by')").first()["value"] == "me"
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == rows.where("day <= '03'").select("year", "month", "day").distinct().count()
    with pytest.raises(ValueError):
        register_partitioned_table(spark, name, scratch_path(spark, "elsewhere"), TRANSFERS)
    spark.sql(f"DROP TABLE {name}")
