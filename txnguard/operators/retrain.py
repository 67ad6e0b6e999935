"""ML-14: the scheduled retrain job for dataset 1, as one callable.

read -> prepare -> validate -> assemble -> fit (seeded) -> save a new version
-> append one metrics row. The caller schedules it; no loop or sleep here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.models import new_version, save
from ..specs import TRANSFERS, DatasetSpec
from .ml import features_for, metrics, score, split, train


def retrain(
    spark: SparkSession,
    df: DataFrame,
    base: str,
    metrics_path: str,
    name: str = "model1",
    spec: DatasetSpec = TRANSFERS,
    key_cols=None,
    seed: int = 42,
    version: str | None = None,
    partitions: int | None = None,
) -> dict:
    feats = features_for(df, spec)
    # The dataset's row id where it has one, else all its features and the label.
    keys = list(key_cols or [c for c in spec.keep if c == "transaction_id"] or [*spec.features, spec.label])
    tr, te = split(feats, keys, 0.7, seed)
    model = train(tr.select("features", spec.label), spec.label, seed, partitions=partitions)
    version = version or new_version()
    path = save(model, base, name, version)
    num_trees = model.stages[-1].getNumTrees
    row = metrics(score(model, te), spec.label).select(
        F.lit(name).alias("model"),
        F.lit(version).alias("version"),
        F.lit(num_trees).alias("num_trees"),
        "*",
    )
    row.write.mode("append").parquet(metrics_path)
    return {"version": version, "path": path, "num_trees": num_trees}
