"""Machine learning: AS-1..3, ML-1..14, SRC-8, SNK-3, EXT-4, EXT-5."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters
from ..operators import ml
from ..operators.retrain import retrain
from ..session import scratch_path
from ..sinks.models import save
from ..sources.models import latest_complete_version, load_latest
from ..specs import CARD_BEHAVIOUR, CARD_TRANSACTIONS, TRANSFERS
from .registry import register

SEED = 42
NOTEBOOK_SEED = 2025


def _real_double(c, alias=None):
    return f"CAST(CAST({c} AS REAL) AS DOUBLE) AS {alias or c}"


@register(
    "as1_assemble_transfers",
    "SELECT nameOrig || '_' || CAST(step AS VARCHAR) AS transaction_id, "
    + _real_double("amount", "f0")
    + ", CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE 0.0 END AS f1 FROM transfers",
)
def as1(spark, sf):
    """AS-1 with ML-4: the assembled vector of dataset 1, read back by name."""
    v = ml.features_for(adapters.transfers(spark, sf), TRANSFERS)
    return ml.vector_column(v, "features", ["f0", "f1"]).select("transaction_id", "f0", "f1")


@register(
    "as2_assemble_card_behaviour",
    "SELECT "
    + ", ".join(
        _real_double(c, f"f{i}") if i < 3 else f"CAST({c} AS DOUBLE) AS f{i}"
        for i, c in enumerate(CARD_BEHAVIOUR.features)
    )
    + " FROM card_behaviour",
)
def as2(spark, sf):
    v = ml.features_for(adapters.card_behaviour(spark, sf), CARD_BEHAVIOUR)
    names = [f"f{i}" for i in range(len(CARD_BEHAVIOUR.features))]
    return ml.vector_column(v, "features", names).select(*names)


@register(
    "as3_assemble_card_transactions",
    f"SELECT transaction_id, {_real_double('amt', 'f0')} FROM card_transactions",
)
def as3(spark, sf):
    v = ml.features_for(adapters.card_transactions(spark, sf), CARD_TRANSACTIONS)
    return ml.vector_column(v, "features", ["f0"]).select("transaction_id", "f0")


def _train_transfers(spark, sf, kind="random_forest"):
    feats = ml.features_for(adapters.transfers(spark, sf), TRANSFERS)
    tr, te = ml.split(feats, ["transaction_id"], 0.7, SEED)
    model = ml.train(tr.select("features", "fraud"), "fraud", SEED, kind)
    return model, te


def _u(seed, *keys):
    """The split's hash of the keys, in SQL."""
    text = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
    return f"CAST(('0x' || substr(md5(concat_ws('|', {text}, '{seed}')), 1, 8)) AS BIGINT) / 4294967296.0"


def _evaluated(m, floor=0.0):
    """A metrics row's columns that don't depend on the fit: the test part's classes,
    and whether all metrics are shares and the accuracy is above a floor."""
    own = [c for c in ("dataset", "model") if c in m.columns]
    return m.select(
        *own, (F.col("tp") + F.col("fn")).alias("test_frauds"), (F.col("tn") + F.col("fp")).alias("test_valid"),
        ((F.col("accuracy") > floor) & F.greatest("accuracy", "precision", "recall", "f1_weighted").between(0, 1)).alias("accuracy_ok"),
    )


_TRANSFERS_TEST = f"""(SELECT *, nameOrig || '_' || CAST(step AS VARCHAR) AS transaction_id FROM transfers
  WHERE {_u(SEED, "nameOrig || '_' || CAST(step AS VARCHAR)")} >= 0.7) t"""


@register(
    "ml1_train_random_forest",
    f"""SELECT count(*) FILTER (WHERE isFraud = 1) AS test_frauds, count(*) FILTER (WHERE isFraud = 0) AS test_valid,
  true AS accuracy_ok FROM {_TRANSFERS_TEST}""",
)
def ml1(spark, sf):
    """Seeded forest on dataset 1 (70/30 hash split), evaluated on the test part."""
    model, te = _train_transfers(spark, sf)
    return _evaluated(ml.metrics(ml.score(model, te), "fraud"), 0.5)


@register(
    "ml2_score",
    f"SELECT transaction_id, isFraud AS fraud, true AS prediction_ok, true AS probability_ok FROM {_TRANSFERS_TEST}",
)
def ml2(spark, sf):
    """Scored test rows: a class and its probability per transaction; the class is
    fraud where its probability is above one half."""
    model, te = _train_transfers(spark, sf)
    scored = ml.with_fraud_probability(ml.score(model, te))
    p = F.col("fraud_probability")
    agrees = (F.col("prediction") == (p > 0.5).cast("double")) | (F.abs(p - 0.5) < 1e-9)
    return scored.select("transaction_id", F.col("fraud").cast("int").alias("fraud"), agrees.alias("prediction_ok"), p.between(0, 1).alias("probability_ok"))


@register(
    "ml3_fraud_probability",
    f"SELECT count(*) AS rows, true AS varies, CAST(0 AS BIGINT) AS out_of_range FROM {_TRANSFERS_TEST}",
)
def ml3(spark, sf):
    """Distribution check of the class-1 probability (JVM vector access)."""
    model, te = _train_transfers(spark, sf)
    p = ml.with_fraud_probability(ml.score(model, te))
    return p.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.min("fraud_probability") < F.max("fraud_probability")).alias("varies"),
        F.count_if((F.col("fraud_probability") < 0) | (F.col("fraud_probability") > 1)).alias("out_of_range"),
    )


@register(
    "ml4_vector_to_array",
    f"SELECT nameOrig || '_' || CAST(step AS VARCHAR) AS transaction_id, {_real_double('amount', 'amount')}, "
    "CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE 0.0 END AS amount_to_balance_ratio FROM transfers",
)
def ml4(spark, sf):
    v = ml.features_for(adapters.transfers(spark, sf), TRANSFERS).select("transaction_id", "features")
    return ml.vector_column(v, "features", ["amount", "amount_to_balance_ratio"]).drop("features")


@register(
    "ml5_hash_split",
    f"""SELECT CASE WHEN {_u(SEED, 'l_orderkey', 'l_linenumber')} < 0.7 THEN 'train' ELSE 'test' END AS part,
  count(*) AS rows FROM card_behaviour GROUP BY 1""",
)
def ml5(spark, sf):
    """70/30 split of dataset 2 by key hash (seed 42): rows per part."""
    df = adapters.card_behaviour(spark, sf, tags=True)
    tr, te = ml.split(df, ["l_orderkey", "l_linenumber"], 0.7, SEED)
    return tr.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("train").alias("part"), "rows").unionByName(
        te.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("test").alias("part"), "rows")
    )


def _stratified(table, label, keys, frac=0.8, seed=NOTEBOOK_SEED):
    """Test rows per class of the stratified split, in SQL: (label, part, rows)."""
    return f"""(SELECT l AS {label}, CASE WHEN u <= cut THEN 'train' ELSE 'test' END AS part, count(*) AS rows FROM (
  SELECT l, u, quantile_cont(u, {frac}) OVER (PARTITION BY l) AS cut FROM (
    SELECT {label} AS l, {_u(seed, *keys)} AS u FROM {table})) GROUP BY ALL) s"""


@register("ml6_stratified_split", f"SELECT fraud, part, rows FROM {_stratified('card_behaviour', 'fraud', ['l_orderkey', 'l_linenumber'])}")
def ml6(spark, sf):
    """80/20 split of dataset 2 per class (seed 2025): rows per part and class."""
    df = adapters.card_behaviour(spark, sf, tags=True)
    tr, te = ml.stratified_split(df, ["l_orderkey", "l_linenumber"], "fraud", 0.8, NOTEBOOK_SEED)
    cnt = F.count(F.lit(1)).alias("rows")
    return tr.groupBy("fraud").agg(cnt).withColumn("part", F.lit("train")).unionByName(
        te.groupBy("fraud").agg(cnt).withColumn("part", F.lit("test"))
    )


# Balanced accuracy (mean of both classes' recall) that a model of majority class or of
# chance, at 0.5, doesn't come near. On dataset 1 the unweighted learners hardly find the
# label in the features at all: only those that see balanced classes have a floor there.
FLOORS = {
    ("dataset 1", "linear_svm"): 0.65, ("dataset 1", "naive_bayes"): 0.65,
} | {(d, m): 0.85 for d in ("dataset 2", "dataset 3") for m in (
    "logistic_regression", "linear_svm", "naive_bayes", "gradient_boosting", "random_forest_deep")}


def _balanced(m):
    """The test part's classes, and whether the balanced accuracy is above the model's
    floor and all metrics are shares."""
    recalls = [F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1)), F.col("tn") / F.greatest(F.col("tn") + F.col("fp"), F.lit(1))]
    floor = F.lit(0.0)
    for (dataset, model), least in FLOORS.items():
        floor = F.when((F.col("dataset") == dataset) & (F.col("model") == model), least).otherwise(floor)
    shares = F.greatest("accuracy", "precision", "recall", "f1_weighted").between(0, 1)
    return m.select(
        "dataset", "model", (F.col("tp") + F.col("fn")).alias("test_frauds"), (F.col("tn") + F.col("fp")).alias("test_valid"),
        (((recalls[0] + recalls[1]) / 2 >= floor) & shares).alias("balanced_ok"),
    )


def _notebook_metrics(spark, sf, kind):
    """The notebook protocol on dataset 2: all features, 80/20 stratified."""
    df = ml.prepare(adapters.card_behaviour(spark, sf, tags=True), CARD_BEHAVIOUR)
    return ml.compare(
        [("dataset 2", df, CARD_BEHAVIOUR.features, "fraud")],
        [kind],
        NOTEBOOK_SEED,
        key_cols=["l_orderkey", "l_linenumber"],
    )


def _evaluated_sql(dataset, kind, table, label, keys):
    return f"""SELECT '{dataset}' AS dataset, '{kind}' AS model, CAST(sum(rows) FILTER (WHERE {label} = 1) AS BIGINT) AS test_frauds,
  CAST(sum(rows) FILTER (WHERE {label} = 0) AS BIGINT) AS test_valid, true AS balanced_ok
FROM {_stratified(table, label, keys)} WHERE part = 'test'"""


def _dataset2_sql(kind):
    return _evaluated_sql("dataset 2", kind, "card_behaviour", "fraud", ["l_orderkey", "l_linenumber"])


@register("ml7_logistic_regression", _dataset2_sql("logistic_regression"))
def ml7(spark, sf):
    return _balanced(_notebook_metrics(spark, sf, "logistic_regression"))


@register("ml8_linear_svm", _dataset2_sql("linear_svm"))
def ml8(spark, sf):
    return _balanced(_notebook_metrics(spark, sf, "linear_svm"))


def _naive_bayes_sql():
    """ML-9 in closed form: class shares, means and variances of the training part (with
    the learner's smoothing, 1e-9 of the largest variance), and the confusion counts of
    the larger of the two log densities on the test part."""
    feats = CARD_BEHAVIOUR.features
    typed = ", ".join((f"CAST(CAST({c} AS REAL) AS DOUBLE)" if i < 3 else f"CAST({c} AS DOUBLE)") + f" AS f{i}" for i, c in enumerate(feats))
    n = range(len(feats))
    wide = ", ".join(f"var_pop(f{i})" for i in n)
    one = " + ".join(f"ln(2 * pi() * (v{i} + eps)) + (f{i} - m{i}) * (f{i} - m{i}) / (v{i} + eps)" for i in n)
    return f""", rows_ AS (SELECT fraud AS y, {_u(NOTEBOOK_SEED, "l_orderkey", "l_linenumber")} AS u, {typed} FROM card_behaviour),
cut AS (SELECT *, u <= quantile_cont(u, 0.8) OVER (PARTITION BY y) AS train FROM rows_),
smooth AS (SELECT 1e-9 * greatest({wide}) AS eps, count(*) AS total FROM cut WHERE train),
class AS (SELECT y AS c, count(*) AS n, {", ".join(f"avg(f{i}) AS m{i}, var_pop(f{i}) AS v{i}" for i in n)} FROM cut WHERE train GROUP BY y),
test AS (SELECT row_number() OVER () AS rid, * FROM cut WHERE NOT train),
scored AS (SELECT rid, any_value(y) AS y, arg_max(c, ln(n / total) - 0.5 * ({one})) AS p FROM test, class, smooth GROUP BY rid)
SELECT 'dataset 2' AS dataset, 'naive_bayes' AS model, count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 1) AS fp,
  count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 0 AND p = 0) AS tn FROM scored"""


@register("ml9_naive_bayes", _naive_bayes_sql())
def ml9(spark, sf):
    return _notebook_metrics(spark, sf, "naive_bayes").select("dataset", "model", "tp", "fp", "fn", "tn")


@register("ml10_gradient_boosting", _dataset2_sql("gradient_boosting"))
def ml10(spark, sf):
    return _balanced(_notebook_metrics(spark, sf, "gradient_boosting"))


@register("ml11_random_forest_all_features", _dataset2_sql("random_forest_deep"))
def ml11(spark, sf):
    return _balanced(_notebook_metrics(spark, sf, "random_forest_deep"))


@register(
    "ml12_metrics",
    """WITH c AS (SELECT
  count(*) FILTER (WHERE isFraud = 1 AND isFlaggedFraud = 1) AS tp,
  count(*) FILTER (WHERE isFraud = 0 AND isFlaggedFraud = 1) AS fp,
  count(*) FILTER (WHERE isFraud = 1 AND isFlaggedFraud = 0) AS fn,
  count(*) FILTER (WHERE isFraud = 0 AND isFlaggedFraud = 0) AS tn FROM transfers),
r AS (SELECT *, CAST(tp + fp + fn + tn AS DOUBLE) AS n,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
  CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,
  CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0 FROM c)
SELECT tp, fp, fn, tn, CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0.0 END AS accuracy,
  p1 AS precision, r1 AS recall,
  CASE WHEN n > 0 THEN ((CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END) * (tp + fn)
    + (CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END) * (tn + fp)) / n ELSE 0.0 END AS f1_weighted
FROM r""".replace("WITH c AS", ", c AS"),
)
def ml12(spark, sf):
    """Metrics of the dataset's own rule flag against its label."""
    return ml.metrics(adapters.transfers(spark, sf), "isFraud", "isFlaggedFraud")


def notebook_matrices(spark, sf):
    """The notebooks' feature matrices (PR-11, PR-12) for datasets 1-3, with
    the key each split hashes on."""
    from ..operators import encode

    t = encode.category_codes(adapters.transfers(spark, sf), "type").withColumn(
        "isMerchant", F.col("nameDest").startswith("M").cast("int")
    )
    t_feats = ["step", "type", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", "isMerchant"]
    cb = ml.prepare(adapters.card_behaviour(spark, sf, tags=True), CARD_BEHAVIOUR)
    ct = encode.category_codes(adapters.card_transactions(spark, sf), "entry_mode")
    ct_feats = ["bin", "amt", "entry_mode", "fraud_scenario"]
    return [
        ("dataset 1", t, t_feats, "isFraud", ["o_orderkey"]),
        ("dataset 2", cb, CARD_BEHAVIOUR.features, "fraud", ["l_orderkey", "l_linenumber"]),
        ("dataset 3", ct, ct_feats, "fraud", ["transaction_id"]),
    ]


# The comparison table's models, ML-7 to ML-11.
COMPARISON_MODELS = ["logistic_regression", "linear_svm", "naive_bayes", "gradient_boosting", "random_forest_deep"]


@register(
    "ml13_model_comparison",
    "SELECT * FROM (" + " UNION ALL ".join(
        _evaluated_sql(d, kind, table, label, keys)
        for d, table, label, keys in (
            ("dataset 1", "transfers", "isFraud", ["o_orderkey"]),
            ("dataset 2", "card_behaviour", "fraud", ["l_orderkey", "l_linenumber"]),
            ("dataset 3", "card_transactions", "fraud", ["transaction_id"]),
        )
        for kind in COMPARISON_MODELS
    ) + ") x",
)
def ml13(spark, sf):
    """Models x datasets, notebook protocol: all notebook features, 80/20 stratified
    split, seed 2025; the classes of the test parts and the floors."""
    return _balanced(_comparison(spark, sf))


@register("ml13_comparison_metrics")
def ml13_metrics(spark, sf):
    """The comparison table itself: confusion counts, accuracy, precision, recall, F1."""
    return _comparison(spark, sf)


def _comparison(spark, sf):
    from concurrent.futures import ThreadPoolExecutor

    def one(entry):
        name, df, feats, label, keys = entry
        return ml.compare([(name, df, feats, label)], COMPARISON_MODELS, NOTEBOOK_SEED, key_cols=keys)

    matrices = notebook_matrices(spark, sf)
    # The datasets are independent: their (small, iterative) fits run side by side.
    with ThreadPoolExecutor(max_workers=len(matrices)) as pool:
        parts = list(pool.map(one, matrices))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


@register(
    "ml14_retrain_job",
    f"""SELECT 'model1' AS model, '20250101_000000' AS version, 10 AS num_trees,
  count(*) FILTER (WHERE isFraud = 1) AS test_frauds, count(*) FILTER (WHERE isFraud = 0) AS test_valid FROM {_TRANSFERS_TEST}""",
)
def ml14(spark, sf):
    """One scheduled retrain: new version saved, metrics row appended."""
    base, mpath = scratch_path(spark, "models"), scratch_path(spark, "model-metrics")
    retrain(spark, adapters.transfers(spark, sf), base, mpath, seed=SEED, version="20250101_000000")
    row = spark.read.parquet(mpath)
    return row.select("model", "version", "num_trees", (F.col("tp") + F.col("fn")).alias("test_frauds"), (F.col("tn") + F.col("fp")).alias("test_valid"))


@register(
    "snk3_src8_model_versions",
    "SELECT '20250101_120000' AS version, count(*) AS rows, true AS predictions_ok FROM transfers",
)
def snk3_src8(spark, sf):
    """Save three models as one version, add an incomplete newer version, then
    load the newest complete one and score dataset 1 with it."""
    base = scratch_path(spark, "models")
    specs = [("model1", TRANSFERS, adapters.transfers), ("model2", CARD_BEHAVIOUR, adapters.card_behaviour),
             ("model3", CARD_TRANSACTIONS, adapters.card_transactions)]
    for name, spec, load in specs:
        feats = ml.features_for(load(spark, sf), spec).select("features", spec.label)
        model = ml.train(feats, spec.label, SEED)
        save(model, base, name, "20250101_120000")
        if name == "model1":  # newer but incomplete: must not be picked
            save(model, base, name, "20250102_080000")
    version, models = load_latest(spark, base)
    assert version == latest_complete_version(spark, base) == "20250101_120000"
    scored = ml.with_fraud_probability(
        ml.score(models["model1"], ml.features_for(adapters.transfers(spark, sf), TRANSFERS, labelled=False))
    )
    return scored.agg(
        F.lit(version).alias("version"), F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("prediction").isin(0.0, 1.0)).alias("predictions_ok")
    )


@register("ext4_area_under_pr", f"SELECT count(*) AS test_rows, true AS area_ok FROM {_TRANSFERS_TEST}")
def ext4(spark, sf):
    model, te = _train_transfers(spark, sf)
    aupr = ml.area_under_pr(ml.score(model, te), "fraud")
    return te.agg(F.count(F.lit(1)).alias("test_rows")).withColumn("area_ok", F.lit(0.0 <= aupr <= 1.0))


@register(
    "ext5_ensemble",
    f"SELECT o_orderkey, CAST(3 AS BIGINT) AS models, true AS mean_ok, true AS flag_ok FROM {_TRANSFERS_TEST}",
)
def ext5(spark, sf):
    """Three models on dataset 1 combined per transaction (mean probability)."""
    feats = ml.features_for(adapters.transfers(spark, sf), TRANSFERS)
    tr, te = ml.split(feats, ["transaction_id"], 0.7, SEED)
    preds = []
    for kind in ("random_forest", "logistic_regression", "naive_bayes"):
        m = ml.train(tr.select("features", "fraud"), "fraud", SEED, kind)
        preds.append(ml.with_fraud_probability(ml.score(m, te)).select("o_orderkey", "fraud_probability"))
    out = ml.ensemble(preds, key="o_orderkey")
    parts = [F.col(f"model{i}_probability") for i in (1, 2, 3)]
    mean = (parts[0] + parts[1] + parts[2]) / 3
    return out.select(
        "o_orderkey", sum(p.isNotNull().cast("long") for p in parts).alias("models"),
        (F.abs(mean - F.col("ensemble_probability")) < 1e-9).alias("mean_ok"),
        (F.col("is_fraud") == (F.col("ensemble_probability") > 0.5)).alias("flag_ok"),
    )
