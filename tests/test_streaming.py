"""Streaming over file sources with availableNow: scoring, restart without
duplicates, and the arrival join equal to its batch form."""

import os

from pyspark.sql import functions as F

from txnguard import adapters
from txnguard.operators import ingest, joins, ml
from txnguard.session import scratch_path
from txnguard.sinks import dated, fs
from txnguard.specs import CARD_BEHAVIOUR, CARD_TRANSACTIONS, TRANSFERS
from txnguard.streaming import score as st


def _records(spark, sf, spec, load, path):
    ingest.encode_json(load(spark, sf, tags=True), spec).write.text(path)
    return path


def test_score_stream_restart_no_duplicates(spark, sf):
    spec = CARD_TRANSACTIONS
    base = scratch_path(spark, "st-test")
    df = adapters.card_transactions(spark, sf, tags=True)
    recs = ingest.encode_json(df, spec)
    a, b = ml.split(recs, ["value"], 0.5, 3)
    a.write.text(os.path.join(base, "in", "p1"))
    model = ml.train(ml.features_for(adapters.card_transactions(spark, sf), spec).select("features", "fraud"), "fraud", 1)
    out, ck = os.path.join(base, "out"), os.path.join(base, "ck")

    def run():
        st.score(st.read_stream(spark, "files", os.path.join(base, "in", "*")), model, spec, out, ck,
                 available_now=True).awaitTermination()

    run()
    n1 = dated.read(spark, out).count()
    b.write.text(os.path.join(base, "in", "p2"))
    run()
    got = dated.read(spark, out).drop("date")
    assert n1 < got.count() == df.count() == got.select("id").distinct().count()
    r = got.agg(F.min("fraud_probability").alias("lo"), F.max("fraud_probability").alias("hi")).first()
    assert 0 <= r.lo <= r.hi <= 1
    assert set(got.columns) == {"id", "fraud", "customer_id", "fraud_probability", "amount", "timestamp"}


def test_invalid_records_do_not_stop_scoring(spark, sf):
    spec = TRANSFERS
    base = scratch_path(spark, "st-bad")
    good = ingest.encode_json(adapters.transfers(spark, sf, tags=True), spec)
    bad = spark.createDataFrame([("not json",), ('{"step":1}',)], "value string")
    good.unionByName(bad).write.text(os.path.join(base, "in"))
    model = ml.train(ml.features_for(adapters.transfers(spark, sf), spec).select("features", "fraud"), "fraud", 1)
    q = st.score(st.read_stream(spark, "files", os.path.join(base, "in")), model, spec,
                 os.path.join(base, "out"), os.path.join(base, "ck"), available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(base, "out")).count() == good.count()


def test_join_stream_as_written_equals_batch(spark, sf):
    base = scratch_path(spark, "st-join")
    specs = [(TRANSFERS, adapters.transfers), (CARD_BEHAVIOUR, adapters.card_behaviour),
             (CARD_TRANSACTIONS, adapters.card_transactions)]
    streams = [(st.read_stream(spark, "files", _records(spark, sf, s, load, os.path.join(base, s.name))), s)
               for s, load in specs]
    counts = st.join_counts_stream(streams, bounded=False)
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("join_counts_test")
         .option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.hour, r.minute): r.n_joined for r in spark.table("join_counts_test").collect() if r.n_joined}
    keys = ["hour", "minute"]
    a, b, c = (load(spark, sf, tags=True).select(*keys) for _, load in specs)
    want = {(r.hour, r.minute): r.n_joined for r in joins.key_counts(a, b, c, keys).collect()}
    assert got == want
    st.run_all(spark, [q], timeout=1)
    assert not spark.streams.active


def test_speed_layer_job(spark, sf):
    from txnguard.jobs import speed_layer
    from txnguard.sinks.models import save

    base = scratch_path(spark, "speed")
    models = os.path.join(base, "models")
    loaders = {"model1": (TRANSFERS, adapters.transfers), "model2": (CARD_BEHAVIOUR, adapters.card_behaviour),
               "model3": (CARD_TRANSACTIONS, adapters.card_transactions)}
    sources = {}
    for name, (spec, load) in loaders.items():
        feats = ml.features_for(load(spark, sf), spec).select("features", spec.label)
        save(ml.train(feats, spec.label, 3), models, name, "20250301_000000")
        sources[name] = {"kind": "files", "path": _records(spark, sf, spec, load, os.path.join(base, spec.name))}
    out, ck = os.path.join(base, "out"), os.path.join(base, "ck")
    speed_layer(spark, models, sources, out, ck, available_now=True)
    assert not spark.streams.active
    for name, (spec, load) in loaders.items():
        assert dated.read(spark, os.path.join(out, f"predictions_{spec.name}")).count() == load(spark, sf).count()
    joined = dated.read(spark, os.path.join(out, "predictions_joined_counts")).drop("date")
    assert joined.count() > 0 and set(joined.columns) == {"arrival", "n1", "n2", "n3", "n_joined"}


def test_quarantine_stream(spark, sf):
    spec = TRANSFERS
    base = scratch_path(spark, "st-quarantine")
    good = ingest.encode_json(adapters.transfers(spark, sf, tags=True), spec)
    bad = spark.createDataFrame([("not json",), ('{"step":1}',), ('{"step":"x","amount":"12"}',)], "value string")
    good.unionByName(bad).write.text(os.path.join(base, "in"))
    q = st.start_sink(st.quarantine_stream(st.read_stream(spark, "files", os.path.join(base, "in")), spec),
                      os.path.join(base, "out"), os.path.join(base, "ck"), "quarantine-test", available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(os.path.join(base, "out"))
    assert got.count() == 3
    assert {r._raw for r in got.collect()} == {"not json", '{"step":1}', '{"step":"x","amount":"12"}'}
    assert all(r.reason.startswith("missing:") for r in got.collect())


def test_session_default_stream_checkpoint(spark, sf):
    from txnguard.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark)
    assert spark.conf.get("spark.sql.streaming.checkpointLocation").startswith(base.rstrip("/"))
    out = scratch_path(spark, "st-default-ckpt")
    src = _records(spark, sf, CARD_TRANSACTIONS, adapters.card_transactions, out + "-in")
    q = (st.read_stream(spark, "files", src).writeStream.format("parquet").queryName("default_ckpt_test")
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    assert spark.read.parquet(out).count() == adapters.card_transactions(spark, sf).count()


MINUTE = '"year":"2024","month":"03","day":"05","hour":"{h}","minute":"{m}"'
BODIES = {
    TRANSFERS.name: '"step":1,"type":"PAYMENT","amount":10.5,"nameOrig":"C1","oldbalanceOrg":50.0',
    CARD_BEHAVIOUR.name: '"distance_from_home":1.0',
    CARD_TRANSACTIONS.name: '"amt":9.5,"customer_id":"c{i}","transaction_id":"t{i}"',
}
ORDER = (TRANSFERS, CARD_BEHAVIOUR, CARD_TRANSACTIONS)


def _send(spark, base, spec, minutes, extra=()):
    lines = ["{" + MINUTE.format(h=m // 60, m=m % 60) + "," + BODIES[spec.name].format(i=m) + "}" for m in minutes]
    rows = spark.createDataFrame([(x,) for x in [*lines, *extra]], "value string")
    rows.coalesce(1).write.mode("append").text(os.path.join(base, spec.name))


def _run_join(spark, base, make, name):
    streams = [(st.read_stream(spark, "files", os.path.join(base, s.name)), s) for s in ORDER]
    out = os.path.join(base, name)
    st.start_sink(make(streams), out, os.path.join(base, f"ck-{name}"), name, available_now=True).awaitTermination()
    return spark.read.parquet(out).collect()


def test_lagging_stream_loses_no_minute(spark):
    base = scratch_path(spark, "st-lag")
    bad = ["not json", '{"hour":"99","minute":"1"}', '{"year":"2024","month":"03","day":"05","hour":null,"minute":"7"}']
    for s in ORDER[:2]:
        _send(spark, base, s, range(120), bad)
    _send(spark, base, ORDER[2], [0], bad)
    joins_ = {"counts": lambda x: st.join_counts_stream(x), "rows": st.join_rows_stream}
    for name, make in joins_.items():
        assert len(_run_join(spark, base, make, name)) == 0  # nothing is closed yet
    _send(spark, base, ORDER[2], range(1, 120))
    for s in ORDER:  # later traffic on all three closes the minutes
        _send(spark, base, s, [500 + ORDER.index(s)])
    counts = _run_join(spark, base, joins_["counts"], "counts")
    assert len(counts) == 120 and all(r.n_joined == 1 for r in counts)
    rows = _run_join(spark, base, joins_["rows"], "rows")
    assert sorted(r.transaction_id for r in rows) == sorted(f"t{m}" for m in range(120)) and all(r.n_joined == 1 for r in rows)


def test_as_written_join_has_no_null_or_empty_keys(spark):
    base = scratch_path(spark, "st-null")
    for k, s in enumerate(ORDER):
        _send(spark, base, s, [5, 10 + k], ["not json", '{"hour":"25","minute":"0"}'])
    streams = [(st.read_stream(spark, "files", os.path.join(base, s.name)), s) for s in ORDER]
    q = (st.join_counts_stream(streams, bounded=False).writeStream.outputMode("complete").format("memory")
         .queryName("as_written_nulls").option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert [(r.hour, r.minute, r.n_joined) for r in spark.table("as_written_nulls").collect()] == [("0", "5", 1)]
    quarantined = st.join_quarantine_stream(st.read_stream(spark, "files", os.path.join(base, ORDER[0].name)), ORDER[0])
    st.start_sink(quarantined, os.path.join(base, "q"), os.path.join(base, "ck-q"), "join-quarantine", available_now=True).awaitTermination()
    assert spark.read.parquet(os.path.join(base, "q")).count() == 2


def test_unlabelled_records_are_scored(spark, sf):
    spec, base = CARD_TRANSACTIONS, scratch_path(spark, "st-unlabelled")
    model = ml.train(ml.features_for(adapters.card_transactions(spark, sf), spec).select("features", "fraud"), "fraud", 1)
    _send(spark, base, spec, [1, 2])
    st.score(st.read_stream(spark, "files", os.path.join(base, spec.name)), model, spec, os.path.join(base, "out"),
             os.path.join(base, "ck"), available_now=True).awaitTermination()
    got = spark.read.parquet(os.path.join(base, "out")).collect()
    assert len(got) == 2 and all(r.fraud is None and 0 <= r.fraud_probability <= 1 for r in got)


def test_records_land_compressed(spark, sf):
    from txnguard.plans.q_streaming import write_records

    path = write_records(spark, sf, CARD_TRANSACTIONS, scratch_path(spark, "records"))
    files = [f for f in fs.list_files(spark, path) if f.startswith("part-")]
    assert files and all(f.endswith(".snappy") for f in files)
    plain = ingest.encode_json(adapters.card_transactions(spark, sf, tags=True), CARD_TRANSACTIONS)
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(r.value for r in plain.collect())


def test_join_counts_and_rows_from_one_state(spark, monkeypatch):
    base = scratch_path(spark, "one-state")
    specs = [TRANSFERS, CARD_BEHAVIOUR, CARD_TRANSACTIONS]

    def land(part, minutes):
        for spec, held in zip(specs, minutes):
            values = [('{"year":"2024","month":"03","day":"01","hour":"7","minute":"%d","transaction_id":"%s%d"}' % (m, part, i),) for i, m in enumerate(held)]
            closing = ('{"year":"2024","month":"03","day":"%s","hour":"0","minute":"0"}' % {"a": "02", "b": "03"}[part],)
            spark.createDataFrame([*values, closing, ("not json",)], "value string").coalesce(1).write.mode("append").text(os.path.join(base, spec.name))

    parsed = []
    real = F.from_json
    monkeypatch.setattr(F, "from_json", lambda c, schema, *a: (parsed.append(schema.names), real(c, schema, *a))[1])
    tables = {os.path.join(base, "counts"): st.counts_of, os.path.join(base, "rows"): lambda rows: rows.drop("n1", "n2", "n3")}

    def run():
        streams = [(st.read_stream(spark, "files", os.path.join(base, s.name)), s) for s in specs]
        rows = st.join_rows_stream(streams, counts=True)
        st.start_dated_sinks(rows, tables, os.path.join(base, "ck"), "one-state", available_now=True, ts_col="arrival").awaitTermination()
        counts, rows = (dated.read(spark, t) for t in tables)
        return (
            sorted((r.arrival.minute, r.n1, r.n2, r.n3, r.n_joined) for r in counts.where("day(arrival) = 1").collect()),
            sorted((r.transaction_id, r.arrival.minute, r.n_joined) for r in rows.where("day(arrival) = 1").collect()),
        )

    land("a", ([1, 1, 2, 5], [1, 2, 2, 2, 6], [1, 2, 2, 5, 6]))
    first = [(1, 2, 1, 1, 2), (2, 1, 3, 2, 6)], [("a0", 1, 2), ("a1", 2, 3), ("a2", 2, 3)]
    assert run() == first
    assert all(set(p) <= {"year", "month", "day", "hour", "minute", "transaction_id", "customer_id"} for p in parsed) and parsed
    assert run() == first
    land("b", ([], [], []))
    assert run() == first


def test_fewer_fields_decode_alike(spark):
    values = ['{"hour":"3","minute":"4","amt":"x","year":"2024"}', '{"hour":"3","amt":1.5,', "not json", '{"hour":3,"minute":[1],"bin":"z"}', '{"amt":2,"amt":3}', '{"hour":"3","bin":99999999999,"minute":"4"}', None, "{}"]
    rows = spark.createDataFrame([(v, str(i)) for i, v in enumerate(values)], "value string, record_id string")
    some = ["hour", "minute", "year", "amt"]
    whole, few = (ingest.decode(rows, CARD_TRANSACTIONS, fields=f).select("record_id", "_raw", *some).collect() for f in (None, some))
    assert few == whole
    tags = ingest.decode(rows, CARD_TRANSACTIONS, fields=["hour", "minute"]).select("record_id", "hour", "minute").collect()
    assert [tuple(r) for r in tags] == [(r.record_id, r.hour, r.minute) for r in whole]
