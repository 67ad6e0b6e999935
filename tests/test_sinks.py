"""Keyed tables, dated sinks, clustered views and the model registry: replays, readers
beside writers, half-done attempts, and how many files a read opens."""

import os
import random
import threading
from collections import Counter

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from txnguard import jobs
from txnguard.operators import serving
from txnguard.session import scratch_path
from txnguard.sinks import cells, dated, fs
from txnguard.sinks import models as saved
from txnguard.sinks import views as v
from txnguard.sources import models
from txnguard.streaming import score as st

# ---- SV-2: clustered views ------------------------------------------------------


def test_lookup_reads_one_file_of_many(spark):
    out = scratch_path(spark, "clustered")
    rows = spark.range(5000).select(F.concat(F.lit("C"), F.col("id")).alias("customer_id"), (F.col("id") * 2).alias("n")).repartition(7)
    path = v.replace_view(spark, rows, out, "risk", key="customer_id", files=12)
    assert len(spark.read.parquet(path).inputFiles()) == 12
    for i in (0, 17, 4999):
        got = v.lookup_view(spark, out, "risk", "customer_id", f"C{i}")
        assert len(got.inputFiles()) == 1 and [tuple(r) for r in got.collect()] == [(f"C{i}", 2 * i)]
    assert v.lookup_view(spark, out, "risk", "customer_id", "D").collect() == []
    absent = v.lookup_view(spark, out, "risk", "customer_id", "C17x")  # inside a range: the Bloom filter's case
    assert absent.count() == 0 and len(absent.inputFiles()) <= 1
    assert v.read_view(spark, out, "risk").count() == 5000
    assert v.lookup_view(spark, out, "none", "customer_id", "C1") is None


def test_lookup_of_plain_repeated_and_empty_views(spark):
    out = scratch_path(spark, "clustered-odd")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, x string")
    v.replace_view(spark, df, out, "plain")
    assert sorted(r.x for r in v.lookup_view(spark, out, "plain", "k", 1).collect()) == ["a", "b"]
    v.replace_view(spark, df, out, "keyed", key="k", files=3)
    assert sorted(r.x for r in v.lookup_view(spark, out, "keyed", "k", 1).collect()) == ["a", "b"]
    v.replace_view(spark, df.where("false"), out, "none", key="k")
    assert v.lookup_view(spark, out, "none", "k", 1).count() == 0 and v.read_view(spark, out, "none").count() == 0


# ---- SNK-2: keyed tables --------------------------------------------------------


def test_upserts_leave_the_last_row_of_each_key(spark):
    rng, base, want = random.Random(2), scratch_path(spark, "keyed"), {}
    for n in range(4):
        rows = [(rng.choice(["a", "b", None]), rng.randint(0, 30), rng.randint(0, 5), n) for _ in range(60)]
        batch = spark.createDataFrame(rows, "k1 string, k2 int, at int, n int")
        assert cells.upsert(batch, base, ["k1", "k2"], n, order="at", buckets=5)
        newest = {}
        for r in rows:
            newest[r[:2]] = max(newest.get(r[:2], r), r, key=lambda r: r[2:])
        want |= newest
        again = batch.withColumn("at", F.lit(99))  # a replay, even with other rows
        assert not cells.upsert(again, base, ["k1", "k2"], n, order="at", buckets=5)
        assert Counter(map(tuple, cells.read(spark, base).collect())) == Counter(want.values())
    for key in (("a", 3), (None, 7), ("zz", 1)):
        got = [tuple(r) for r in cells.lookup(spark, base, ["k1", "k2"], key).collect()]
        assert got == ([want[key]] if key in want else [])
    assert cells.read(spark, scratch_path(spark, "none")) is None


def test_upsert_rewrites_touched_buckets_only(spark):
    base = scratch_path(spark, "keyed-touched")
    cells.upsert(spark.range(2000).withColumn("x", F.lit(1)), base, ["id"], 0, buckets=32)
    before = {r.cell: r.path for r in cells.manifest(spark, base).collect()}
    assert len(before) == 32
    cells.upsert(spark.createDataFrame([(5, 2), (5000, 2)], "id long, x int"), base, ["id"], 1)
    after = {r.cell: r.path for r in cells.manifest(spark, base).collect()}
    assert 1 <= sum(after[c] != before[c] for c in before) <= 2
    found = cells.lookup(spark, base, ["id"], [5])
    assert found.first().x == 2 and len({os.path.dirname(f) for f in found.inputFiles()}) == 1
    assert cells.read(spark, base).count() == 2001
    assert cells.expire(spark, base, 3600) == []
    assert len(cells.expire(spark, base, -60)) <= 1 and cells.read(spark, base).where("x = 1").count() == 1999


def test_unpublished_attempt_changes_nothing(spark, monkeypatch):
    base = scratch_path(spark, "keyed-crash")
    cells.upsert(spark.range(50).withColumn("x", F.lit(1)), base, ["id"], 0, buckets=4)
    second = spark.range(50).withColumn("x", F.lit(2))
    with monkeypatch.context() as m:
        m.setattr(cells, "replace_view", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            cells.upsert(second, base, ["id"], 1)
    assert cells.read(spark, base).where("x = 2").count() == 0 and cells.last_batch(spark, base) == 0
    assert cells.upsert(second, base, ["id"], 1) and cells.read(spark, base).where("x = 2").count() == 50


def test_cells_take_no_rows_of_others(spark):
    base = scratch_path(spark, "cells")
    df = spark.createDataFrame([("x", 1), ("y", 2)], "day string, n int")
    cells.replace(df, base, "day", ["x", "y"])
    with pytest.raises(ValueError):
        cells.replace(df, base, "day", ["x"])
    cells.replace(df.where("false"), base, "day", ["x"])
    assert [r.n for r in cells.read(spark, base).collect()] == [2]
    assert cells.read(spark, base, ["x"]).collect() == [] and cells.read(spark, base, ["no"]).collect() == []


# ---- SNK-2: dated sinks ---------------------------------------------------------


def batch_of(spark, n, day, rows=40):
    ts = F.to_timestamp_ntz(F.concat(F.lit(f"2024-03-{day:02d} 00:"), F.lpad((F.col("id") % 60).cast("string"), 2, "0"), F.lit(":00")))
    return spark.range(rows).select((F.col("id") + n * 1000).cast("string").alias("id"), (F.col("id") % 9 == 0).alias("fraud"), ts.alias("timestamp"))


def test_replays_and_compaction(spark):
    base = scratch_path(spark, "dated")
    for n in range(12):
        assert dated.append(batch_of(spark, n, 1 + n // 4), base, n)
        assert not dated.append(batch_of(spark, n, 9), base, n)
    whole = Counter(map(tuple, dated.read(spark, base).collect()))
    assert sum(whole.values()) == 480 and len(dated.runs(spark, base)) == 12
    run = dated.compact(spark, base, "2024-03-03")
    assert run and len(dated.runs(spark, base)) == 5
    assert Counter(map(tuple, dated.read(spark, base).collect())) == whole
    day = dated.read(spark, base, ["2024-03-01"])
    assert len(day.inputFiles()) == 1 and day.count() == 160 and set(day.columns) == {"id", "fraud", "timestamp", "date"}
    assert dated.compact(spark, base, "2024-03-03") is None  # nothing new is closed
    assert not dated.append(batch_of(spark, 2, 9), base, 2)  # a replay of a compacted batch
    assert dated.expire(spark, base, 3600) == [] and len(dated.expire(spark, base, -60)) == 8
    assert Counter(map(tuple, dated.read(spark, base).collect())) == whole
    dated.append(batch_of(spark, 12, 1), base, 12)  # late rows of a compacted day
    dated.append(batch_of(spark, 13, 4), base, 13)
    assert dated.compact(spark, base, "2024-03-04") and len(dated.runs(spark, base)) == 3
    assert dated.read(spark, base, ["2024-03-01"]).count() == 200 and len(dated.read(spark, base, ["2024-03-01"]).inputFiles()) == 2


def test_runs_without_marker_time_or_rows(spark):
    base = scratch_path(spark, "dated-odd")
    assert dated.read(spark, base) is None and dated.compact(spark, base, "9999-01-01") is None and dated.newest(spark, base, F.lit(True), 3) is None
    none = batch_of(spark, 0, 1).where("false")
    dated.append(none, base, 0)
    assert dated.read(spark, base).count() == 0 and dated.newest(spark, base, F.col("fraud"), 3).count() == 0
    dated.append(batch_of(spark, 1, 1).withColumn("timestamp", F.when(F.col("fraud"), F.col("timestamp"))), base, 1)
    dated.append(none, base, 2)
    half = batch_of(spark, 3, 1).withColumn("date", F.lit("2024-03-01"))
    half.write.partitionBy("date").parquet(os.path.join(base, "run=000000000003-000000000003-00000000"))  # never published
    assert dated.read(spark, base).count() == 40 and dated.read(spark, base).where("date IS NULL").count() == 35
    assert [r.timestamp is None for r in dated.newest(spark, base, F.lit(True), 40).collect()] == [False] * 5 + [True] * 35
    assert dated.compact(spark, base, "9999-01-01") and dated.read(spark, base).count() == 40
    assert dated.append(batch_of(spark, 3, 1), base, 3) and dated.read(spark, base).count() == 80


def test_readers_during_compaction(spark):
    base = scratch_path(spark, "dated-readers")
    for n in range(6):
        dated.append(batch_of(spark, n, 1), base, n)
    wrong, seen = [], []
    done = threading.Event()

    def look():
        while not done.is_set() or len(seen) < 5:
            got = dated.read(spark, base)
            n, ids = got.count(), got.select("id").distinct().count()
            (seen if n == ids and n % 40 == 0 and n >= 240 else wrong).append(n)

    reader = threading.Thread(target=look)
    reader.start()
    try:
        dated.compact(spark, base, "9999-01-01")
        for n in range(6, 9):
            dated.append(batch_of(spark, n, 2), base, n)
        dated.compact(spark, base, "9999-01-01")
    finally:
        done.set()
        reader.join()
    assert seen and not wrong and len(dated.runs(spark, base)) == 2


def test_newest_opens_the_newest_dates_only(spark):
    base = scratch_path(spark, "dated-newest")
    for n in range(10):
        dated.append(batch_of(spark, n, 1 + n), base, n)
    for limit in (1, 5, 6, 17, 1000):
        got = serving.flagged_newest(spark, base, limit)
        want = dated.read(spark, base).where("fraud").orderBy(F.desc("timestamp"), "id").limit(limit)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert {f.split("date=")[1][:10] for f in serving.flagged_newest(spark, base, 5).inputFiles()} == {"2024-03-10"}
    assert len({f.split("date=")[1][:10] for f in serving.flagged_newest(spark, base, 6).inputFiles()}) == 2


def test_a_new_checkpoint_adds_to_the_tables(spark, tmp_path):
    base = scratch_path(spark, "renewed")
    src = os.path.join(base, "in")
    spark.range(10).select(F.col("id").cast("string").alias("value")).write.text(src)

    def rows():
        return st.read_stream(spark, "files", src).select("value", "record_id", F.current_timestamp().alias("timestamp"))

    for ck in ("one", "one", "two"):
        st.start_dated_sink(rows(), os.path.join(base, "dated"), os.path.join(base, ck), "a", available_now=True).awaitTermination()
        keyed = rows().withColumn("run", F.lit(ck))
        st.start_keyed_sink(keyed, os.path.join(base, "keyed"), os.path.join(base, ck + "-k"), "b", ["value"], buckets=2, available_now=True).awaitTermination()
    assert dated.read(spark, os.path.join(base, "dated")).count() == 20
    assert [tuple(r) for r in cells.read(spark, os.path.join(base, "keyed")).groupBy("run").count().collect()] == [("two", 10)]
    fs.create_marker(spark, os.path.join(base, "other"))
    done = jobs.compact_sinks(spark, base, "9999-01-01", expire_after=-60)
    assert set(done) == {"dated"} and dated.read(spark, os.path.join(base, "dated")).count() == 20
    assert len(dated.runs(spark, os.path.join(base, "dated"))) == 1


# ---- SNK-3, SRC-8: the model registry -------------------------------------------


def pipeline_model(spark, out):
    return Pipeline(stages=[VectorAssembler(inputCols=["id"], outputCol=out)]).fit(spark.range(1))


def test_half_saved_models_are_never_loaded(spark, monkeypatch):
    base = scratch_path(spark, "registry")
    names = ("model1", "model2")
    for n in names:
        saved.save(pipeline_model(spark, "first"), base, n, "20250101_000000")
    with monkeypatch.context() as m:  # the writer is lost after its files, before the marker
        m.setattr(fs, "create_marker", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        for n in names:
            with pytest.raises(RuntimeError):
                saved.save(pipeline_model(spark, "half"), base, n, "20250303_000000")
    pipeline_model(spark, "half").write().save(os.path.join(base, "model1_20250404_000000"))  # no attempt at all
    assert models.versions(spark, base) == {"20250101_000000": set(names)}
    version, loaded = models.load_newest(spark, base, names)
    assert version == "20250101_000000" and loaded["model1"].stages[0].getOutputCol() == "first"
    assert models.load_latest(spark, base, names)[0] == "20250101_000000"
    assert models.load_latest(spark, scratch_path(spark, "no-registry"), names) is None


def test_of_two_writers_of_a_version_the_later_is_loaded_whole(spark):
    base = scratch_path(spark, "registry-two")
    made = [pipeline_model(spark, f"w{k}") for k in range(2)]
    threads = [threading.Thread(target=lambda k=k: [saved.save(made[k], base, "model1", "20250101_000000") for _ in range(3)]) for k in range(2)]
    for t in threads:
        t.start()
    found = []
    while any(t.is_alive() for t in threads):
        got = models.load_newest(spark, base, ("model1",))
        if got:
            found.append(got[1]["model1"].stages[0].getOutputCol())
    for t in threads:
        t.join()
    assert set(found) <= {"w0", "w1"}
    path = saved.save(pipeline_model(spark, "last"), base, "model1", "20250101_000000")
    assert models.load_newest(spark, base, ("model1",))[1]["model1"].stages[0].getOutputCol() == "last" == models.load(path).stages[0].getOutputCol()
