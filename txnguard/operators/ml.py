"""Spark ML: feature assembly (AS-1..3), splits (ML-5, ML-6), training and
scoring (ML-1..4, ML-7..11), metrics and comparison (ML-12, ML-13), the
retrain job (ML-14) and the ensemble row (EXT-5).

Training is Spark ML's own distributed fit; everything around it (splits,
metrics, probability extraction) is DataFrame expressions, with no Python UDF.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_quantiles, hash_unit, prob_class1, vec_item
from ..operators import encode
from ..specs import CARD_BEHAVIOUR, CARD_TRANSACTIONS, RF_PARAMS, TRANSFERS, DatasetSpec

FEATURES = "features"
# Partitions of the training layout follow the rows, never the cluster: part of the
# model's definition like the seed.
LAYOUT_ROWS = 500_000
LAYOUT_LEAST = 8


def prepare(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Per-dataset preparation before assembly (PR-1, PR-3..6)."""
    if spec is TRANSFERS:
        out = encode.with_transaction_id(encode.prepare_transfers(df))
        return out.withColumns({"amount": F.col("amount").cast("float"), "fraud": F.col("fraud").cast("int")})
    if spec is CARD_BEHAVIOUR:
        return df.withColumns(
            {c: F.col(c).cast("float") for c in encode.CARD_BEHAVIOUR_FLOATS}
            | {c: F.col(c).cast("int") for c in encode.CARD_BEHAVIOUR_INTS}
        )
    if spec is CARD_TRANSACTIONS:
        return df.withColumns({"amt": F.col("amt").cast("float"), "fraud": F.col("fraud").cast("int")})
    return df


def assemble(df: DataFrame, features: Sequence[str], out: str = FEATURES) -> DataFrame:
    """AS-1..3: assemble the feature vector. Inputs must be validated first:
    a NULL feature fails the query (``handleInvalid="error"``, Q7)."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def features_for(df: DataFrame, spec: DatasetSpec, labelled: bool = True) -> DataFrame:
    """Validated rows -> prepared and assembled, with the kept columns. Training
    needs the label; scoring (``labelled=False``) doesn't."""
    prepared = prepare(df, spec)
    valid = prepared.dropna(subset=list(spec.features) + [spec.label] * labelled)
    return assemble(valid, spec.features)


# ---- splits ----------------------------------------------------------------


def split(df: DataFrame, key_cols: Sequence[str], train_frac: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """ML-5: repeatable random split by a hash of the key, so the same row
    lands on the same side whatever the partitioning or retry."""
    u = hash_unit(key_cols, seed)
    marked = df.withColumn("_u", u)
    return marked.where(F.col("_u") < train_frac).drop("_u"), marked.where(F.col("_u") >= train_frac).drop("_u")


def stratified_split(
    df: DataFrame, key_cols: Sequence[str], label: str, train_frac: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """ML-6: per-class split at the class's own ``train_frac`` hash quantile
    (exact), so every class keeps its share in both parts. The cut points are
    read as literals: no row is shuffled on its label."""
    return split_at(df.withColumn("_u", hash_unit(key_cols, seed)), label, train_frac)


def split_at(marked: DataFrame, label: str, train_frac: float) -> tuple[DataFrame, DataFrame]:
    """``stratified_split`` of rows that have their hash as ``_u``."""
    classes = per_class(marked, label, F.count(F.lit(1)))
    cuts = {k: exact_quantiles(marked.where(F.col(label) == F.lit(k)), "_u", [train_frac]).first()[0] for k in classes}
    in_train = F.col("_u") <= _by_class(label, cuts)
    # NULL labels have no class, and no part: as in an inner join.
    return marked.where(in_train).drop("_u"), marked.where(~in_train).drop("_u")


MAX_CLASSES = 100


def per_class(df: DataFrame, label: str, value) -> dict:
    """One number per class of ``label``, from one aggregate with map-side partials.
    Refuses more than ``MAX_CLASSES`` classes: then it isn't a label."""
    rows = df.where(F.col(label).isNotNull()).groupBy(label).agg(value.alias("_v")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return {r[0]: r[1] for r in rows}


def _by_class(label: str, values: dict):
    """The class's number as an expression: rows stay where they are."""
    out = F.lit(None).cast("double")
    for k, v in values.items():
        out = F.when(F.col(label) == F.lit(k), F.lit(float(v))).otherwise(out)
    return out


# ---- models ------------------------------------------------------------------


def check_two_classes(df: DataFrame, label: str) -> None:
    """Refuse single-class training data: class 1 would not exist (Q22)."""
    n = df.agg(F.countDistinct(label).alias("n")).first()["n"]
    if n < 2:
        raise ValueError(f"training data has {n} label class(es); need 2")


def random_forest(label: str = "fraud", seed: int = 42, **overrides) -> RandomForestClassifier:
    """ML-1 estimator: the reference's forest, always seeded (Q21)."""
    params = dict(RF_PARAMS) | overrides
    return RandomForestClassifier(labelCol=label, featuresCol=FEATURES, seed=seed, **params)


def estimator(kind: str, label: str, seed: int, weight_col: str | None = None, gbt_iter: int = 100, max_bins: int = 32):
    """ML-7..11: the notebook's model family on Spark ML."""
    if kind == "random_forest":
        return random_forest(label, seed)
    if kind == "random_forest_deep":  # ML-11: grown without a bound there; 30 is the most here
        # Deep trees: each row's node is kept, not found from the root again on every pass.
        return random_forest(label, seed, maxDepth=30, cacheNodeIds=True)
    if kind == "logistic_regression":
        return LogisticRegression(labelCol=label, featuresCol=FEATURES, maxIter=100)
    if kind == "linear_svm":
        return LinearSVC(labelCol=label, featuresCol=FEATURES, maxIter=100, weightCol=weight_col)
    if kind == "naive_bayes":
        return NaiveBayes(labelCol=label, featuresCol=FEATURES, modelType="gaussian")
    if kind == "gradient_boosting":
        gbt = GBTClassifier(labelCol=label, featuresCol=FEATURES, maxIter=gbt_iter, maxDepth=3, stepSize=0.1, seed=seed, maxBins=max_bins)
        return gbt.setWeightCol(weight_col) if weight_col else gbt
    raise ValueError(f"unknown model kind {kind}")


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Class weight n / (k * n_class) for k classes, like sklearn's
    ``class_weight="balanced"``; the counts are read as literals."""
    counts = per_class(df, label, F.count(F.lit(1)))
    n, k = sum(counts.values()), len(counts)
    return df.where(F.col(label).isNotNull()).withColumn(out, _by_class(label, {c: n / (k * m) for c, m in counts.items()}))


def layout_partitions(rows: int) -> int:
    """How many partitions a training set of so many rows is dealt into."""
    return max(LAYOUT_LEAST, -(-rows // LAYOUT_ROWS))


def training_layout(df: DataFrame, partitions: int | None = None, as_double: Sequence[str] = ()) -> DataFrame:
    """Rows dealt by a hash of their content into a number of partitions and sorted
    there; the number follows the count of rows unless it is given. Tree learners
    sample per partition; so laid out, a model depends on the rows and the seed, not
    on how the input was split or on the cluster. Columns ``as_double`` are hashed as
    doubles, so a column's type doesn't matter either."""
    partitions = partitions or layout_partitions(df.count())
    arrays = {f"_k{i}": vector_to_array(c) for i, (c, t) in enumerate(df.dtypes) if t == "vector"}
    keys = [f"_k{i}" if f"_k{i}" in arrays else c for i, c in enumerate(df.columns)]
    content = [F.col(k).cast("double") if k in as_double else arrays.get(k, F.col(k)) for k in keys]
    # Sort keys are made where the rows were dealt to: they don't travel.
    dealt = df.repartition(partitions, F.xxhash64(*content))
    return dealt.withColumns(arrays).sortWithinPartitions(*keys).drop(*arrays)


def train(
    df: DataFrame, label: str = "fraud", seed: int = 42, kind: str = "random_forest", partitions: int | None = None, **kw
) -> PipelineModel:
    """Fit a one-stage pipeline on assembled rows (ML-1 and ML-7..11). ``partitions``
    are those of ``training_layout``, ``kw`` options of the estimator.

    The learners make several passes (label check, metadata, split candidates,
    then the iterations); the assembled training set is persisted once so the
    upstream scan and joins run once, and released after the fit. Storage is
    memory-and-disk: a lost executor's blocks are recomputed from lineage.
    """
    weight_col = None
    if kind == "linear_svm":
        df = balanced_weights(df, label)
        weight_col = "weight"
    cached = training_layout(df, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit(cached, label, seed, kind, weight_col, **kw)
    finally:
        cached.unpersist()


def fit(laid: DataFrame, label: str, seed: int, kind: str, weight_col: str | None = None, **kw) -> PipelineModel:
    """``train`` on assembled rows that stand in their layout and are kept."""
    check_two_classes(laid, label)
    return Pipeline(stages=[estimator(kind, label, seed, weight_col, **kw)]).fit(laid)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """ML-2: rawPrediction, probability (when the model has one), prediction."""
    return model.transform(df)


def with_fraud_probability(scored: DataFrame, out: str = "fraud_probability") -> DataFrame:
    """ML-3: probability of class 1, JVM-side (no Python UDF, sparse-safe)."""
    if "probability" in scored.columns:
        return scored.withColumn(out, prob_class1("probability"))
    return scored.withColumn(out, F.col("prediction").cast("double"))


# ---- boosting on cells ---------------------------------------------------------

BINS = 32  # of the tree learners here, as Spark's default
CELL_BINS = 1024
FEW_VALUES = 5_000  # a feature's distinct values that are counted one by one
GRID = 2_000  # points that stand for the values of a feature with more
FINE_VALUES = 256  # a feature with no more keeps each of its values in a forest's cells
ROWS_A_CELL = 4  # so many rows a cell at least, or a forest is fitted on the rows
GROWN_AT_ONCE = 4  # trees of a forest; a fit's first and last passes leave cores idle


def bin_edges(df: DataFrame, feats: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Split candidates of each feature, by the tree learners' rule (all midpoints of few
    values, else cuts of equal shares), from all rows: exact counts of a feature's
    values, or quantiles at ``GRID`` points where it has more than ``FEW_VALUES``."""
    return _edges_of(*value_counts(df, feats), bins)


def _edges_of(weights: Sequence[dict], n: int, bins: int, all_of: int = 0) -> list[list[float]]:
    """Split candidates by ``value_counts``; all midpoints where there are at most ``all_of`` values."""
    return [_edges(sorted(w.items()), n, len(w) if len(w) <= all_of else min(bins, n) - 1) for w in weights]


def value_counts(df: DataFrame, feats: Sequence[str]) -> tuple[list[dict], int]:
    """Each feature's values with their rows (of one with many, those at ``GRID`` points), and all rows."""
    x = [F.col(f).cast("double") for f in feats]
    grid = [i / GRID for i in range(GRID + 1)]
    known = [c.isNotNull() & ~F.isnan(c) for c in x]  # others stop the fit at the assembler
    n, *found = df.agg(F.count(F.lit(1)), *(F.approx_count_distinct(c) for c in x)).first()
    few = [i for i, d in enumerate(found) if d <= FEW_VALUES]
    many = [i for i, d in enumerate(found) if d > FEW_VALUES]
    weights: list[dict] = [{} for _ in feats]
    if few:
        value = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), x[i].alias("v")) for i in few))).alias("c")
        for i, v, m in df.select(value).groupBy("c.i", "c.v").agg(F.count(F.lit(1))).where("v IS NOT NULL AND NOT isnan(v)").collect():
            weights[i][v] = m
    if many:
        points = df.agg(*(F.percentile_approx(F.when(known[i], x[i]), grid, 20_000) for i in many)).first()
        for i, at in zip(many, points):
            for v in at:
                weights[i][v] = weights[i].get(v, 0) + n / len(grid)
    return weights, n


def _edges(counts: list[tuple[float, float]], n: float, most: int) -> list[float]:
    """Midpoints between neighbours of ``counts`` (value, rows): all, or those nearest to equal shares."""
    mids = [(a + b) / 2 for (a, _), (b, _) in zip(counts, counts[1:])]
    if len(mids) <= most:
        return mids
    out, stride = [], n / (most + 1)
    target, seen = stride, counts[0][1]
    for mid, (_, m) in zip(mids, counts[1:]):
        before, seen = seen, seen + m
        if abs(before - target) < abs(seen - target):
            out.append(mid)
            target += stride
    return out


def binned(df: DataFrame, feats: Sequence[str], edges: Sequence[Sequence[float]]) -> DataFrame:
    """``df`` with the bin of each feature, from 1, in place of its value; a value on an
    edge is below it, as in a tree."""
    above = [sorted({u for e in es if math.isfinite(u := math.nextafter(e, math.inf))}) for es in edges]
    up = [[-math.inf, *(a or [0.0]), math.inf] for a in above]  # a constant is in one bin anyway
    names = [f"_b{i}" for i in range(len(feats))]
    wide = df.withColumns({f: F.col(f).cast("double") for f in feats})
    out = Bucketizer(inputCols=list(feats), outputCols=names, splitsArray=up, handleInvalid="error").transform(wide)
    return out.withColumns({f: F.col(b) + 1 for f, b in zip(feats, names)}).drop(*names)


COPIES = [0.0]  # bounds of a row's copies in a bootstrap sample, Poisson(1), on a uniform number
while not COPIES[1:] or COPIES[-1] > COPIES[-2]:
    COPIES.append(sum(math.exp(-1) / math.factorial(i) for i in range(len(COPIES))))
COPIES = [c for c in COPIES[:-1] if c < 1.0] + [1.0]


def cells(df: DataFrame, feats: Sequence[str], label: str, edges: Sequence[Sequence[float]], samples: int = 0, seed: int = 0) -> DataFrame:
    """Rows with equal bins and label as one row with their count as ``weight``. With
    ``samples``, ``copies0``, ``copies1``, ... are the rows' copies in that many bootstrap
    samples of ``df``, drawn row by row before they are counted (per partition, as the
    tree learners draw them: ``df`` has to stand in a layout)."""
    drawn = [f"_r{i}" for i in range(samples)]
    out = binned(df.withColumns({r: F.rand(seed + 1_000_003 * (i + 1)) for i, r in enumerate(drawn)}), feats, edges)
    if samples:
        names = [f"copies{i}" for i in range(samples)]
        out = Bucketizer(inputCols=drawn, outputCols=names, splitsArray=[COPIES] * samples).transform(out)
        sums = [F.sum(c).alias(c) for c in names]
    else:
        sums = []
    return out.groupBy(*feats, label).agg(F.count(F.lit(1)).cast("double").alias("weight"), *sums)


def boost(cells: DataFrame, feats: Sequence[str], label: str, seed: int, partitions: int | None = None, **kw) -> PipelineModel:
    """ML-10's boosted trees, fitted on ``cells``.

    A tree learner sees a row only by its bins, so rows with equal bins and label are
    one row with their count as its weight: the trees are those of the rows, and the
    hundred rounds pass over the cells. Of them there are at most as many as rows, and
    as many as combinations of bins (flags have two, others ``BINS``). Bins are values
    now: the learner may have ``CELL_BINS``, so it tries all of them and samples none
    of up to the square of that many cells for it.
    """
    plain = cells.select(*feats, label, "weight")
    kept = assemble(training_layout(plain, partitions), feats).select(FEATURES, label, "weight").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit(kept, label, seed, "gradient_boosting", "weight", max_bins=CELL_BINS, **kw)
    finally:
        kept.unpersist()


def boost_cells(tr: DataFrame, te: DataFrame, feats: Sequence[str], label: str, seed: int, partitions: int | None = None, **kw) -> DataFrame:
    """``te`` scored by ML-10's boosted trees, fitted on the cells of ``tr``."""
    edges = bin_edges(tr, feats)
    kept = cells(tr, feats, label, edges).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = boost(kept, feats, label, seed, partitions, **kw)
    finally:
        kept.unpersist()
    return score(model, assemble(binned(te, feats, edges), feats))


def grow_forest(cells: DataFrame, feats: Sequence[str], label: str, seed: int, partitions: int | None = None, **kw) -> list[PipelineModel]:
    """ML-11's trees, each fitted on the cells of its own bootstrap sample (``copies`` of
    ``cells``): a tree learner sees a row only by its bins, so a tree of cells is one of
    rows. As many trees as the samples, each from its own seed."""
    samples = [c for c in cells.columns if c.startswith("copies")]
    classes = int(cells.agg(F.max(label)).first()[0]) + 1  # a sample may lack one
    named = F.col(label).cast("double").alias(label, metadata={"ml_attr": {"type": "nominal", "name": label, "vals": [str(i) for i in range(classes)]}})
    check_two_classes(cells, label)
    laid = assemble(training_layout(cells, partitions), feats).select(FEATURES, named, *samples).persist(StorageLevel.MEMORY_AND_DISK)

    def grow(i: int) -> PipelineModel:
        # One tree has no sample of its own; it tries as many features at a node as one of a forest.
        one = estimator("random_forest_deep", label, seed + i, **kw).setNumTrees(1).setBootstrap(False).setFeatureSubsetStrategy("sqrt")
        one = one.setMaxBins(CELL_BINS).setWeightCol(samples[i])
        return Pipeline(stages=[one]).fit(laid.where(F.col(samples[i]) > 0))

    try:
        laid.count()
        with ThreadPoolExecutor(max_workers=GROWN_AT_ONCE) as pool:
            return list(pool.map(grow, range(len(samples))))
    finally:
        laid.unpersist()


def vote(trees: Sequence[PipelineModel], df: DataFrame, out: str = "prediction") -> DataFrame:
    """Assembled rows with the forest's class: the largest sum of the trees' class
    shares, the lower class of equals, as Spark's forest votes."""
    kept, shares = list(df.columns), []
    for i, tree in enumerate(trees):
        df = score(tree, df).select(*kept, *shares, vector_to_array("probability").alias(f"_t{i}"))
        shares.append(f"_t{i}")
    classes = trees[0].stages[-1].numClasses
    votes = [sum(F.col(s)[c] for s in shares) for c in range(classes)]
    return df.withColumn(out, (F.array_position(F.array(*votes), F.array_max(F.array(*votes))) - 1).cast("double")).drop(*shares)


# ---- metrics -----------------------------------------------------------------


def metrics(df: DataFrame, label: str = "fraud", prediction: str = "prediction", rows: str | None = None) -> DataFrame:
    """ML-12: accuracy, precision and recall of class 1, weighted F1, from one
    confusion-count aggregate. Empty denominators give 0 (sklearn's default). With
    ``rows``, a row stands for as many rows as that column says."""
    y = F.col(label).cast("int")
    p = F.col(prediction).cast("int")

    def count(which):
        return F.count_if(which) if rows is None else F.coalesce(F.sum(F.when(which, F.col(rows))), F.lit(0)).cast("long")

    c = df.agg(
        count((y == 1) & (p == 1)).alias("tp"),
        count((y == 0) & (p == 1)).alias("fp"),
        count((y == 1) & (p == 0)).alias("fn"),
        count((y == 0) & (p == 0)).alias("tn"),
    )

    def ratio(num, den):
        return F.when(den > 0, num / den).otherwise(F.lit(0.0))

    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    prec1, rec1 = ratio(tp, tp + fp), ratio(tp, tp + fn)
    prec0, rec0 = ratio(tn, tn + fn), ratio(tn, tn + fp)
    f1_1 = ratio(2 * prec1 * rec1, prec1 + rec1)
    f1_0 = ratio(2 * prec0 * rec0, prec0 + rec0)
    return c.select(
        "tp", "fp", "fn", "tn",
        ratio(tp + tn, n).alias("accuracy"),
        prec1.alias("precision"),
        rec1.alias("recall"),
        ratio(f1_1 * (tp + fn) + f1_0 * (tn + fp), n).alias("f1_weighted"),
    )


def area_under_pr(scored: DataFrame, label: str = "fraud") -> float:
    """EXT-4: area under the precision-recall curve."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderPR")
    return ev.evaluate(scored.withColumn(label, F.col(label).cast("double")))


def compare(
    datasets: Sequence[tuple[str, DataFrame, Sequence[str], str]],
    kinds: Sequence[str],
    seed: int = 2025,
    train_frac: float = 0.8,
    key_cols: Sequence[str] | None = None,
    partitions: int | None = None,
    cell_rows: int = LAYOUT_ROWS * LAYOUT_LEAST,
    **kw,
) -> DataFrame:
    """ML-13: models x datasets -> metrics rows (precision, recall, ...).

    ``datasets``: (name, frame, feature columns, label). Each is split 80/20
    stratified by label with a hash of ``key_cols`` (all columns by default). With
    over ``cell_rows`` training rows the deep forest is grown on cells, if these are
    far fewer.
    """
    rows = None
    for name, df, feats, label in datasets:
        keys = list(key_cols or df.columns)
        # The frame is read once: the split's cuts, both sides and every model come from
        # its plain columns (kept, a column takes a fraction of a vector), then it is released.
        plain = [F.col(f) if t in NARROW else F.col(f).cast("double").alias(f) for f, t in zip(feats, _types(df, feats))]
        kept = df.select(*plain, label, hash_unit(keys, seed).alias("_u")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tr, te = split_at(kept, label, train_frac)
            found = _compared(tr, te, feats, label, kinds, seed, partitions, cell_rows, **kw)
        finally:
            kept.unpersist()
        for kind in kinds:
            one = found[kind].select(F.lit(name).alias("dataset"), F.lit(kind).alias("model"), "*")
            rows = one if rows is None else rows.unionByName(one)
    return rows


NARROW = ("tinyint", "smallint", "int", "float")  # a double holds each value


def _types(df: DataFrame, cols: Sequence[str]) -> list[str]:
    types = dict(df.dtypes)
    return [types[c] for c in cols]


def _compared(tr: DataFrame, te: DataFrame, feats: Sequence[str], label: str, kinds: Sequence[str], seed: int, partitions: int | None, cell_rows: int, **kw) -> dict[str, DataFrame]:
    """Each model's metrics. The models of rows share one layout and one pass over
    ``te``; boosting and, beyond ``cell_rows`` training rows, the deep forest share the
    cells of both sides."""
    on_rows = [k for k in kinds if k not in ("gradient_boosting", "random_forest_deep")]
    forest, boosted = "random_forest_deep" in kinds, "gradient_boosting" in kinds
    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    models, found = {}, {}
    pool = ThreadPoolExecutor(max_workers=1)
    try:
        # One layout for all models of the dataset.
        laid = hold(training_layout(tr, partitions, feats)) if on_rows or forest else None
        samples = 0
        if forest and laid.count() > cell_rows:
            samples = RF_PARAMS["numTrees"]
        elif forest:
            on_rows.append("random_forest_deep")
        if samples or boosted:
            counts = value_counts(tr, feats)
            coarse = _edges_of(*counts, BINS)
            fine = _edges_of(*counts, BINS, FINE_VALUES) if samples else coarse
            trees_in = hold(cells(laid if samples else tr, feats, label, fine, samples, seed))
            trees_out = hold(cells(te, feats, label, fine))
            if samples:
                n, m = trees_in.agg(F.count(F.lit(1)), F.sum("weight")).first()
                if n * ROWS_A_CELL > m:  # hardly fewer cells than rows: those go as they are
                    on_rows.append("random_forest_deep")
                    samples = 0

        def on_cells() -> None:
            if samples:
                grown = grow_forest(trees_in, feats, label, seed, partitions, **kw)
                found["random_forest_deep"] = spark_rows(metrics(vote(grown, assemble(trees_out, feats)), label, rows="weight"))
            if boosted:
                few, out = trees_in, trees_out
                if fine != coarse:  # every coarse edge is a fine one
                    among = [[f.index(e) + 1.5 for e in c] for f, c in zip(fine, coarse)]
                    few, out = (binned(t, feats, among).groupBy(*feats, label).agg(F.sum("weight").alias("weight")) for t in (few, out))
                model = boost(few, feats, label, seed, partitions, **kw)
                found["gradient_boosting"] = spark_rows(metrics(score(model, assemble(out, feats)), label, rows="weight"))

        # The fits on cells are many small jobs: they run beside those on rows.
        beside = pool.submit(on_cells)
        for kind in on_rows:
            weight = "weight" if kind == "linear_svm" else None
            rows_in = balanced_weights(laid, label) if weight else laid
            models[kind] = fit(assemble(rows_in, feats), label, seed, kind, weight, **kw)
        if models:  # all of them in one pass: the rows of each label and predictions, counted
            scored = assemble(te, feats).select(label, FEATURES)
            for i, kind in enumerate(models):
                scored = score(models[kind], scored).select(label, FEATURES, *(f"_p{j}" for j in range(i)), F.col("prediction").alias(f"_p{i}"))
            predicted = [f"_p{i}" for i in range(len(models))]
            counted = spark_rows(scored.groupBy(label, *predicted).agg(F.count(F.lit(1)).alias("_n")))
            for i, kind in enumerate(models):
                found[kind] = spark_rows(metrics(counted, label, f"_p{i}", "_n"))
        beside.result()
        return found
    finally:
        pool.shutdown()
        for df in held:
            df.unpersist()


def spark_rows(m: DataFrame) -> DataFrame:
    """A result of few rows as a table of its own, free of the plan that made it."""
    return m.sparkSession.createDataFrame(m.collect(), m.schema)


def ensemble(preds: Sequence[DataFrame], key: str = "transaction_id", threshold: float = 0.5) -> DataFrame:
    """EXT-5: one row per transaction with each model's probability, their mean
    and the flag (mean > threshold). Each input: (key, fraud_probability)."""
    out = None
    for i, p in enumerate(preds, 1):
        side = p.select(key, F.col("fraud_probability").alias(f"model{i}_probability"))
        out = side if out is None else out.join(side, key, "full")
    probs = [F.col(f"model{i}_probability") for i in range(1, len(preds) + 1)]
    present = sum(F.when(c.isNotNull(), 1).otherwise(0) for c in probs)
    total = sum(F.coalesce(c, F.lit(0.0)) for c in probs)
    return out.withColumn("ensemble_probability", total / present).withColumn(
        "is_fraud", F.col("ensemble_probability") > threshold
    )


def vector_column(df: DataFrame, col: str, names: Sequence[str]) -> DataFrame:
    """ML-4: named columns from a vector column (JVM ``vector_to_array``)."""
    return df.withColumns({n: vec_item(col, i) for i, n in enumerate(names)})
