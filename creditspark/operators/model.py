"""Boosted-tree training, evaluation per split and random search over trials that share one binned table."""

from __future__ import annotations

import random
import statistics
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from creditspark import schema as S
from creditspark.operators import boosting as B
from creditspark.operators.curve import rank_metrics
from creditspark.operators.features import fit_features
from creditspark.operators.metrics import calibrate_threshold, class_imbalance, classification_metrics
from creditspark.session import fresh_dir, stored

# --- fixed values: model defaults and search ranges ------------------------------
MODEL_DEFAULTS = {
    "n_estimators": 500,
    "learning_rate": 0.05,
    "max_depth": 6,
    "min_child_weight": 1,
    "subsample": 0.8,
    "colsample": 0.8,
    "reg_alpha": 0.1,
    "reg_lambda": 1.0,
}
LEAF_WISE_DEFAULTS = {
    "n_estimators": 500,
    "learning_rate": 0.05,
    "num_leaves": 31,
    "max_depth": -1,
    "min_child_samples": 20,
    "subsample": 0.8,
    "colsample": 0.8,
    "reg_alpha": 0.1,
    "reg_lambda": 0.1,
}
EARLY_STOP_ROUNDS = 50
N_TRIALS = 50
SEARCH_SPACE = {
    "n_estimators": ("int", 100, 1000, 50),
    "learning_rate": ("log", 1e-3, 0.3),
    "max_depth": ("int", 3, 10, 1),
    "min_child_weight": ("int", 1, 10, 1),
    "subsample": ("float", 0.5, 1.0),
    "colsample": ("float", 0.5, 1.0),
    "reg_alpha": ("log", 1e-8, 10.0),
    "reg_lambda": ("log", 1e-8, 10.0),
    "gamma": ("float", 0.0, 5.0),
}
LEAF_WISE_SPACE = {
    "n_estimators": ("int", 100, 1000, 50),
    "learning_rate": ("log", 1e-3, 0.3),
    "num_leaves": ("int", 15, 127, 1),
    "max_depth": ("int", 3, 12, 1),
    "min_child_samples": ("int", 5, 100, 1),
    "subsample": ("float", 0.5, 1.0),
    "colsample": ("float", 0.5, 1.0),
    "reg_alpha": ("log", 1e-8, 10.0),
    "reg_lambda": ("log", 1e-8, 10.0),
}
# ------------------------------------------------------------------------------------

_ABSENT = {"min_child_weight": 0.0, "min_child_samples": 1, "gamma": 0.0}


def full_params(params: dict | None = None) -> dict:
    """Every parameter of a fit: by level, or leaf by leaf where ``num_leaves`` is named."""
    given = params or {}
    return {**_ABSENT, **(LEAF_WISE_DEFAULTS if "num_leaves" in given else MODEL_DEFAULTS), **given}


def fit_boosted(
    rows: DataFrame | B.Binned, params: dict | None = None, seed: int = 42, patience: int = EARLY_STOP_ROUNDS
) -> B.BoostedTrees:
    """Model of the train rows, cut at the round with the lowest validation loss; one fit, ended by ``patience``."""
    return B.fit(rows if isinstance(rows, B.Binned) else B.Binned(rows), full_params(params), seed, patience)


def training_rows(split_loans: DataFrame, features: PipelineModel, target: str = S.TARGET_COLUMN) -> DataFrame:
    """Feature vectors of the train and validation rows, positives weighted up."""
    fit_rows = split_loans.filter(F.col("split").isin("train", "val"))
    weight = class_imbalance(split_loans.filter(F.col("split") == "train"), target).select("scale_pos_weight").scalar()
    return (
        features.transform(fit_rows)
        .select(
            "features",
            F.col(target).cast("double").alias("label"),
            (F.col("split") == "val").alias("is_val"),
        )
        .withColumn("weight", F.when(F.col("label") == 1, weight).otherwise(1.0))
    )


def train(
    split_loans: DataFrame, params: dict | None = None, seed: int = 42
) -> tuple[PipelineModel, B.BoostedTrees]:
    """Feature stages fitted on train, and the model fitted on train with early stopping."""
    features = fit_features(split_loans.filter(F.col("split") == "train"))
    return features, fit_boosted(training_rows(split_loans, features), params, seed)


def predict(rows: DataFrame, features: PipelineModel, model: B.BoostedTrees) -> DataFrame:
    """Rows with ``default_probability`` and the feature vector."""
    return B.predict(features.transform(rows).select(*rows.columns, "features"), model)


def save_model(features: PipelineModel, model: B.BoostedTrees, path: str) -> None:
    """Feature stages and trees under one folder."""
    features.write().save(f"{path}/features")
    model.save(SparkSession.active(), path)


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, B.BoostedTrees]:
    return PipelineModel.load(f"{path}/features"), B.BoostedTrees.load(spark, path)


def evaluate_splits(scored: DataFrame, target: str = S.TARGET_COLUMN) -> DataFrame:
    """(split, auc_roc, gini, ks_statistic, n_samples, n_positives) from one score curve."""
    return rank_metrics(scored, "default_probability", target, ["split"])


def train_result(
    split_loans: DataFrame, run_id: str, model_name: str, params: dict | None = None, seed: int = 42
) -> DataFrame:
    """One row: run, model, validation and test AUC, calibrated threshold, parameters."""
    features, model = train(split_loans, params, seed)
    scored = predict(split_loans, features, model)
    val, test = (scored.filter(F.col("split") == s) for s in ("val", "test"))
    threshold = calibrate_threshold(val, "default_probability", S.TARGET_COLUMN).first()["threshold"]
    metrics = {
        name: classification_metrics(part, "default_probability", S.TARGET_COLUMN, threshold)
        for name, part in (("val", val), ("test", test))
    }
    pairs = [F.lit(str(x)) for kv in (params or {}).items() for x in kv]
    return (
        metrics["val"]
        .select(F.col("auc_roc").alias("val_auc"))
        .withColumn("test_auc", metrics["test"].select("auc_roc").scalar())
        .withColumn("threshold", F.lit(threshold))
        .withColumn("run_id", F.lit(run_id))
        .withColumn("model_name", F.lit(model_name))
        .withColumn("params", F.create_map(*pairs).cast("map<string,string>"))
        .select("run_id", "model_name", "val_auc", "test_auc", "threshold", "params")
    )


def draw_trials(n_trials: int, seed: int = 42, space: dict | None = None) -> list[dict]:
    """Parameter sets drawn at random from the ranges, the same for the same seed."""
    rng, trials = random.Random(seed), []
    for _ in range(n_trials):
        trial = {}
        for name, (kind, low, high, *step) in (space or SEARCH_SPACE).items():
            if kind == "int":
                trial[name] = rng.randrange(low, high + 1, step[0])
            elif kind == "log":
                trial[name] = low * (high / low) ** rng.random()
            else:
                trial[name] = rng.uniform(low, high)
        trials.append(trial)
    return trials


def random_search(
    split_loans: DataFrame,
    trials: list[dict],
    parallelism: int = 8,
    seed: int = 42,
    target: str = S.TARGET_COLUMN,
    prune: bool = False,
    step: int = B.JOB_ROUNDS,
    patience: int = EARLY_STOP_ROUNDS,
) -> DataFrame:
    """(trial, params, val_auc, rounds, pruned) per parameter set; ``runs.best_trial`` picks the best.

    All trials read one binned table, and go on by turns of ``step`` rounds, several trials at a time,
    those of the most rounds first. ``prune``: a trial whose least validation loss after a turn lies above
    the median of all trials then is ended; its AUC is that of its rounds so far. Only then trials wait
    for each other after a turn.
    """
    spark = split_loans.sparkSession
    features = fit_features(split_loans.filter(F.col("split") == "train"))
    rows = training_rows(split_loans, features, target)
    data = B.Binned(rows)
    full = [full_params(t) for t in trials]
    state: list[tuple[list, list]] = [([], []) for _ in trials]
    pruned: set[int] = set()

    def going(i: int) -> bool:
        losses = state[i][1]
        return i not in pruned and len(losses) < full[i]["n_estimators"] and not (data.has_val and B.stop_at(losses, patience))

    def turn(i: int) -> None:
        state[i] = B.more_rounds(data, full[i], *state[i], min(len(state[i][1]) + step, int(full[i]["n_estimators"])), seed, patience)

    val = stored(rows.filter("is_val").select("features", "label"), "validation")
    scored, rounds = fresh_dir(spark, "trial-scores"), [0] * len(trials)

    def run(i: int) -> None:
        while going(i):
            turn(i)
        model = B.kept(data, *state[i])
        rounds[i], state[i] = model.num_trees, ([], [])  # trees of trials that have ended stay nowhere
        B.predict_all(val, [model], i).write.parquet(f"{scored}/{i}")

    order = sorted(range(len(trials)), key=lambda i: -full[i]["n_estimators"])
    with ThreadPoolExecutor(max(1, min(parallelism, spark.sparkContext.defaultParallelism) // data.tasks)) as pool:
        while prune and data.has_val and (active := [i for i in order if going(i)]):
            list(pool.map(turn, active))
            least = {i: min(state[i][1]) for i in active}
            bar = statistics.median(least.values())
            pruned |= {i for i in active if least[i] > bar}
        list(pool.map(run, order))
    scores = spark.read.schema(B.SCORES).parquet(*[f"{scored}/{i}" for i in order])
    aucs = {r.model: r.auc_roc for r in rank_metrics(scores, "p", "label", ["model"]).collect()}
    results = [
        (i, {k: str(v) for k, v in t.items()}, aucs.get(i), rounds[i], i in pruned) for i, t in enumerate(trials)
    ]
    return spark.createDataFrame(results, "trial int, params map<string,string>, val_auc double, rounds int, pruned boolean")
