"""Boosted trees: matrix, fit, score, search (ML-01, ML-06..09)."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.operators.audit import numeric_columns
from fraudlake.operators.oversample import oversample
from fraudlake.operators.split import with_class_weight, with_fold
from fraudlake.operators.trees import PATIENCE, Booster, TreeModel, blocks_of, cut_points, model_of, model_table
from fraudlake.session import materialize, small_table

MODEL_VERSION = "trees_v2"
RUNGS = (0.25, 0.5, 1.0)  # shares of a trial's trees after which the poorer half of the trials ends
MISSING_VALUE = -999.0
# Columns that are no features.
NOT_FEATURES = ["TransactionID", "isFraud", "card4_amt_bucket"]

# The ranges that the search draws from (low, high, kind).
SEARCH_SPACE = {
    "n_estimators": (200, 1000, "int"),
    "max_depth": (3, 10, "int"),
    "learning_rate": (0.01, 0.3, "log"),
    "subsample": (0.5, 1.0, "float"),
    "colsample_bytree": (0.4, 1.0, "float"),
    "min_child_weight": (1, 10, "int"),
    "gamma": (0.0, 5.0, "float"),
    "reg_alpha": (1e-8, 10.0, "log"),
    "reg_lambda": (1e-8, 10.0, "log"),
}
DEFAULT_PARAMS = {
    "n_estimators": 200,
    "max_depth": 5,
    "learning_rate": 0.1,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "min_child_weight": 2,
    "gamma": 0.0,
    "reg_alpha": 0.0,
    "reg_lambda": 1.0,
}


def feature_matrix(
    df: DataFrame, label: str = "isFraud", row_id: str = "TransactionID", mark_missing: bool = True
) -> tuple[DataFrame, list[str]]:
    """Id, label and the numeric features as doubles; what imputation left missing becomes a
    value below every real one, or stays null without ``mark_missing``.

    That value is MISSING_VALUE, or the next number below the column's least value where that is not
    above it; one scan finds the least values. Trees need no mark, distances between rows do.
    """
    features = numeric_columns(df, [*NOT_FEATURES, label, row_id])
    if not mark_missing:
        kept = [F.col(c).cast("double").alias(c) for c in features]
        return df.select(row_id, F.col(label).cast("long").alias(label), *kept), features
    least = df.agg(*[F.min(F.col(c).cast("double")).alias(c) for c in features]).first() if features else {}
    marks = {
        c: MISSING_VALUE if least[c] is None or least[c] > MISSING_VALUE else math.nextafter(least[c], -math.inf)
        for c in features
    }
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(marks[c])).alias(c) for c in features]
    return df.select(row_id, F.col(label).cast("long").alias(label), *filled), features


def draw_params(trials: int, seed: int = 42, space: dict[str, tuple] = SEARCH_SPACE) -> list[dict[str, float]]:
    """Seeded random draws from the search space."""
    rng = np.random.default_rng(seed)
    drawn = []
    for _ in range(trials):
        params = {}
        for name, (low, high, kind) in space.items():
            if kind == "int":
                params[name] = int(rng.integers(low, high + 1))
            elif kind == "log":
                params[name] = float(np.exp(rng.uniform(np.log(low), np.log(high))))
            else:
                params[name] = float(rng.uniform(low, high))
        drawn.append(params)
    return drawn


def booster(
    train: DataFrame,
    features: Sequence[str],
    params: dict[str, float],
    label: str = "isFraud",
    row_id: str = "TransactionID",
    seed: int = 42,
    validation_flag: str | None = None,
    patience: int = PATIENCE,
    prepared: tuple[DataFrame, list] | None = None,
) -> Booster:
    """A fit that can be continued; ``prepared`` are the blocks and cut points of ``packed``."""
    blocks, cuts = prepared or packed(train, features, label, row_id, validation_flag)
    return Booster(blocks, features, cuts, {**DEFAULT_PARAMS, **params}, seed, validation_flag is not None, patience)


def packed(
    train: DataFrame, features: Sequence[str], label: str = "isFraud", row_id: str = "TransactionID", validation_flag: str | None = None
) -> tuple[DataFrame, list[list[float]]]:
    """Written blocks of binned rows, and the cut points, which are those of the fitted rows.

    Positives have the constant class weight. The key that draws rows is a hash of the whole row.
    """
    flag = F.col(validation_flag) if validation_flag else F.lit(False)
    cuts = cut_points(train.where(~flag), features)
    ready = with_class_weight(train, label).select(
        F.col(label).alias("label"), F.col("class_weight").alias("weight"), flag.alias("valid"),
        F.xxhash64(row_id, *features).alias("key"), *features,
    )
    return materialize(blocks_of(ready, features, cuts)), cuts


def fit_boosted_trees(
    train: DataFrame,
    features: Sequence[str],
    params: dict[str, float],
    label: str = "isFraud",
    seed: int = 42,
    validation_flag: str | None = None,
    row_id: str = "TransactionID",
    patience: int = PATIENCE,
) -> TreeModel:
    """Second-order boosted trees, see ``trees``; positives are weighted by the constant class weight.

    With ``validation_flag`` the flagged rows are not fitted: boosting ends when ``patience`` more trees
    have not raised their AUC, and the model has the trees up to the best round.
    """
    fit = booster(train, features, params, label, row_id, seed, validation_flag, patience)
    fit.advance(int(fit.params["n_estimators"]))
    return fit.model()


def score(
    model: TreeModel,
    df: DataFrame,
    label: str = "isFraud",
    row_id: str = "TransactionID",
    version: str = MODEL_VERSION,
) -> DataFrame:
    """Predictions table: id, label, probability, label at 0.5, model version."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the model's parameters

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            margin = shared.value.margins(batch.iloc[:, 2:].to_numpy(dtype=float))
            p = 1 / (1 + np.exp(-margin))
            out = batch.iloc[:, :2].copy()
            out["fraud_prob"], out["predicted_label"] = p, (p >= 0.5).astype("int64")
            yield out

    columns = df.select(row_id, F.col(label).cast("long").alias(label), *[F.col(c).cast("double") for c in model.features])
    kind = df.schema[row_id].dataType.simpleString()
    scored = columns.mapInPandas(run, f"{row_id} {kind}, {label} long, fraud_prob double, predicted_label long")
    return scored.withColumn("model_version", F.lit(version))


def search(
    train: DataFrame,
    features: Sequence[str],
    candidates: Sequence[dict[str, float]],
    label: str = "isFraud",
    row_id: str = "TransactionID",
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 4,
    use_smote: bool = False,
    rungs: Sequence[float] = RUNGS,
    patience: int = PATIENCE,
) -> list[dict]:
    """One record per candidate: parameters, mean fold AUC, times, state. Best first is not implied.

    Successive halving: all candidates grow the share of their trees that the first of ``rungs`` names;
    the better half goes on to the next rung from there, the others end (state PRUNED, with the AUC
    they had). The held-out fold stops the boosting and gives the score; oversampling sees the other
    folds only. The rows of each fold, oversampled ones included, are binned and written once and read
    by the fits of all candidates, which share the cluster through a small thread pool.
    """
    spark = train.sparkSession
    folded = with_fold(train, label, row_id, folds, seed)
    columns = [row_id, label, *features]

    def fold_rows(fold: int) -> tuple[DataFrame, list]:
        held = F.col("fold") == fold
        fitted, valid = folded.where(~held), folded.where(held)
        if use_smote:
            fitted = oversample(fitted, features, label, row_id, seed=seed)
        rows = fitted.select(*columns).withColumn("is_validation", F.lit(False))
        rows = rows.unionByName(valid.select(*columns).withColumn("is_validation", F.lit(True)))
        return packed(materialize(rows), features, label, row_id, "is_validation")

    prepared = [fold_rows(fold) for fold in range(folds)]
    fits = [
        [booster(train, features, params, label, row_id, seed, "is_validation", patience, prepared[fold]) for fold in range(folds)]
        for params in candidates
    ]
    records = [
        {"number": i, "value": 0.0, "datetime_start": None, "datetime_complete": None, "duration_sec": 0.0}
        | {f"params_{k}": float(v) for k, v in {**DEFAULT_PARAMS, **params}.items()} | {"state": "PRUNED"}
        for i, params in enumerate(candidates)
    ]

    def climb(number: int, share: float) -> None:
        record = records[number]
        started = dt.datetime.now()
        for fit in fits[number]:
            fit.advance(max(1, math.ceil(share * fit.params["n_estimators"])))
        finished = dt.datetime.now()
        record["value"] = float(np.mean([fit.aucs[fit.stop_round()] or 0.0 for fit in fits[number]]))
        record["datetime_start"] = record["datetime_start"] or started
        record["datetime_complete"] = finished
        record["duration_sec"] += (finished - started).total_seconds()

    alive = list(range(len(candidates)))
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        for rung, share in enumerate(rungs):
            list(pool.map(inheritable_thread_target(spark)(lambda number: climb(number, share)), alive))
            if rung + 1 < len(rungs):
                ranked = sorted(alive, key=lambda i: (-records[i]["value"], i))
                alive = sorted(ranked[: -(-len(ranked) // 2)])
    for number in alive:
        records[number]["state"] = "COMPLETE"
    return records


def trials_table(spark: SparkSession, trials: Sequence[dict]) -> DataFrame:
    return spark.createDataFrame(list(trials))


def best_params(trials: Sequence[dict]) -> dict[str, float]:
    """Parameters of the best trial that was not ended early, the earliest one on a tie."""
    best = max((t for t in trials if t["state"] == "COMPLETE"), key=lambda t: (t["value"], -t["number"]))
    return {k.removeprefix("params_"): v for k, v in best.items() if k.startswith("params_")}


def save_model(spark: SparkSession, model: TreeModel, path: str) -> None:
    """Three tables: the nodes of all trees, the names of the features, the parameters."""
    names = [(i, c) for i, c in enumerate(model.features)]
    params = [(k, float(v)) for k, v in model.params.items()]
    tables = {
        "nodes": model_table(spark, model),
        "features": small_table(spark, names, "position long, name string"),
        "params": small_table(spark, params, "name string, value double"),
    }
    for part, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{part}")


def load_model(spark: SparkSession, path: str) -> TreeModel:
    features = spark.read.parquet(f"{path}/features").orderBy("position").collect()
    params = spark.read.parquet(f"{path}/params").collect()
    nodes = spark.read.parquet(f"{path}/nodes")
    return model_of(nodes, [r["name"] for r in features], {r["name"]: r["value"] for r in params})
