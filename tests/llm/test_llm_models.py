"""Language ID by held-out accuracy, exact top-k by brute force, the pipeline end to end."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from txnguard.llm import pivot_topk
from txnguard.llm.common import materialise
from txnguard.llm.language_id import DIMS, Model, identify, keep_identified, language_id, letter_table, presence, train
from txnguard.llm.pivot_topk import pivot_top_k


def test_language_id_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in language_id(docs, sample=60, landmarks=48).collect()}
    true = {r.doc_id: r.lang for r in docs.collect()}
    out = [i for i in true if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in got if got[i].held_out} == set(out)
    assert sum(got[i].lang_pred == true[i] for i in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_id_without_letters_or_model(awkward, make_docs):
    got = language_id(make_docs(awkward, clash=True)).collect()
    assert len(got) == len(awkward)
    und = Counter(i for i, t in awkward if not any(c.isalpha() for c in t or ""))
    assert Counter(r.doc_id for r in got if r.lang_pred == "und") == und
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    empty = make_docs([])
    assert language_id(empty).count() == 0 and train(empty, F.lit(True)) is None
    assert {r.lang_pred for r in identify(make_docs(awkward), None).collect()} == {"und"}


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang")))
    assert language_id(docs).collect() == language_id(changed).collect()


def test_presence_is_of_distinct_n_grams():
    bits, has = presence(["ab", "abab", "1 2", "Ab!", ""], letter_table())
    assert has.tolist() == [True, True, False, True, False] and bits.shape == (5, DIMS)
    assert (bits[0] <= bits[1]).all() and (bits[0] <= bits[3]).all()


def test_model_separates():
    rng = np.random.default_rng(0)
    bits = np.zeros((80, DIMS), np.uint8)
    names = ["x", "y"] * 40
    for i, n in enumerate(names):
        bits[i, rng.choice(500, 60) + (500 if n == "y" else 200)] = 1
    model = Model.fit(bits, names, 32, 0.01, 3.0)
    best, score = model.predict(bits)
    assert [model.languages[b] for b in best] == names and (score > 0.5).all()


def test_keep_identified(awkward, make_docs):
    df = make_docs(awkward, clash=True)
    kept = keep_identified(df, None)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter(i for i, t in awkward if any(c.isalpha() for c in t or ""))


def brute_top(rows, k):
    seen = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            seen[i, tuple(int(np.floor(1024 * float(np.float32(a)))) for a in v)] = 1
    size = max((len(x) for _, x in seen), default=0)
    ids, out = [i for i, _ in seen], Counter()
    table = np.array([[*x, *[0] * (size - len(x))] for _, x in seen], np.int64).reshape(len(seen), size)
    for n, i in enumerate(ids):
        if i % 100 == 0:
            scores = table @ table[n]
            for r, m in enumerate(sorted((m for m in range(len(ids)) if m != n), key=lambda m: (-scores[m], ids[m]))[:k]):
                out[i, r + 1, ids[m], int(scores[m])] += 1
    return out


VECTORS = np.random.default_rng(0).normal(size=(700, 8))


@pytest.mark.parametrize(
    "rows",
    [
        [(i, v.tolist()) for i, v in enumerate(VECTORS)],
        [(i, (VECTORS[0] if i % 3 == 0 else v).tolist()) for i, v in enumerate(VECTORS)]
        + [(5000, None), (5001, [1.0, None]), (5100, [float("nan")] * 8), (5200, [float("inf")] * 8), (None, [1.0] * 8)]
        + [(100, [0.5] * 8), (100, [0.5] * 8), (200, []), (300, [0.1, 0.2]), (0, [9.0] * 8)],
        [(i, v.tolist()) for i, v in enumerate(VECTORS[:4])],
        [(0, []), (100, []), (1, [])],
        [],
    ],
    ids=["plain", "hot and odd", "few", "empty vectors", "empty"],
)
def test_pivot_top_k(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit(1)).withColumn("q", F.lit("x"))
    got = pivot_top_k(df.repartition(3), F.col("vec_id") % 100 == 0, cell_rows=32, pivots=8, group_rows=64).collect()
    assert Counter(map(tuple, got)) == brute_top(rows, 10)


def test_pivot_top_k_a_query_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(pivot_topk, "BOUNDS", 1)
    rows = [(i, v.tolist()) for i, v in enumerate(VECTORS)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = pivot_top_k(df, F.col("vec_id") % 50 == 0, cell_rows=32, pivots=8, group_rows=64).where("query_id % 100 = 0").collect()
    assert Counter(map(tuple, got)) == brute_top(rows, 10)


def test_pipeline(make_docs, spark, awkward):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    n, seen = docs.count(), docs
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialise(stage(spark, docs, ""), name)
        if name != "best_fit_packing":
            assert docs.dtypes == before.dtypes and docs.where("n_chars != char_length(text)").count() == 0
    kept = before
    texts = [r.text for r in kept.collect()]
    assert 0.7 * n < len(texts) <= n and len(texts) == len(set(texts))
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.collect()}
    # Distinct documents that share nothing are left alone.
    sole = seen.where(~F.col("text").rlike("token|password|License|AKIA|\\d")).groupBy("text").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
    assert sole.where("n = 1").join(kept, "doc_id", "left_anti").count() <= 0.05 * n


def test_stages_on_awkward_and_empty_tables(make_docs, spark, awkward):
    for rows in (awkward, []):
        docs = make_docs(rows, clash=True)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, ""), name)
            assert name == "best_fit_packing" or docs.columns == columns


def test_run_is_its_stages(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns[-2:] == ["sequence_id", "offset"]
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_language_sample_of_null_and_repeated_ids(spark):
    """Rows without an id, or of one id, are sampled like any others; repeated rows count once."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang IS NOT NULL")
    want = {r.lang for r in docs.where("text IS NOT NULL").select("lang").distinct().collect()}
    for id_ in (F.lit(None).cast("long"), F.lit(8).cast("long")):
        same = docs.withColumn("doc_id", id_)
        model = train(same.unionByName(same).unionByName(same), F.lit(True), sample=30, landmarks=32)
        assert set(model.languages) == want
        once = train(same, F.lit(True), sample=30, landmarks=32)
        assert np.array_equal(model.landmarks, once.landmarks) and np.array_equal(model.weights, once.weights)
    with pytest.raises(ValueError):
        train(docs, F.lit(True), most_languages=len(want) - 1)


def grams(text):
    """Distinct letter n-grams, all between two letters (and the start) one gap."""
    out, letters = set(), [""]
    for c in text:
        if c.isalpha():
            letters.append(c.lower() if len(c.lower()) == 1 else c)
        elif letters[-1]:
            letters.append("")
    for n in (1, 2, 3):
        out |= {tuple(letters[i : i + n]) for i in range(len(letters) - n + 1)}
    return out


def test_model_against_a_plain_kernel_machine(spark):
    """Sets of n-grams, kernel, Nystroem and ridge written plainly; hashing may join a few n-grams."""
    rows = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect() if r.lang and r.text and len(r.text) < 4000 and any(map(str.isalpha, r.text))]
    learned, asked = rows[:80], rows[80:160]
    names, table = [r.lang for r in learned], letter_table()
    model = Model.fit(presence([r.text for r in learned], table)[0], names, len(learned), 0.01, 3.0)
    best, share = model.predict(presence([r.text for r in asked], table)[0])

    def kernel(a, b):
        return np.array([[len(x & y) / (len(x) * len(y)) ** 0.5 for y in b] for x in a])

    base, new = ([grams(r.text) for r in part] for part in (learned, asked))
    languages = sorted(set(names))
    values, vectors = np.linalg.eigh(kernel(base, base))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    x, y = kernel(base, base) @ whiten, np.array([[1.0 if n == lang else -1.0 for lang in languages] for n in names])
    each = np.diag([1 / names.count(n) for n in names])
    w = np.linalg.solve(x.T @ each @ x + 0.01 * np.eye(x.shape[1]), x.T @ each @ y)
    z = np.exp(3.0 * (kernel(new, base) @ whiten @ w))
    z /= z.sum(1, keepdims=True)
    assert model.languages == languages
    assert [languages[b] for b in z.argmax(1)] == [model.languages[b] for b in best]
    assert np.abs(z.max(1) - share).max() < 0.05
