"""Learned forecasters over the scaled sequences.

Pooled models (spark.ml) are trained on the sequences of all series at once,
by the protocol of ``grid``: train targets fit, validation targets score,
scaled units, ranked per series. Models of one series are in ``linear``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from panelcast.config import ForecastConfig
from panelcast.functions.moments import mse
from panelcast.operators import evaluate, grid, split
from panelcast.operators.grid import Trial
from panelcast.session import materialize

POOLED_GRID = {
    "linear": {"reg": [0.0, 0.1]},
    "forest": {"trees": [20], "depth": [5]},
    "boosted": {"iterations": [20], "depth": [3]},
}
IMPROVEMENT = 0.001


@dataclass(frozen=True)
class PooledRun:
    predictions: DataFrame
    scores: DataFrame
    leaderboard: DataFrame
    forecast: DataFrame


def vectors(inputs: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Flattened context vectors of equal length; a series with fewer features is zero-padded."""
    width = cfg.k_best
    padded = F.slice(F.concat("features", F.array_repeat(F.lit(0.0), width)), 1, width)
    seqs = split.sequences(inputs.withColumn("features", padded), "features", cfg.sequence_length)
    return seqs.select(
        "series_id", "date", "target", "target_center", "target_scale", "is_val_target",
        array_to_vector(F.flatten("sequence")).alias("x"),
    )


def _settled(inputs: DataFrame) -> DataFrame:
    """The scaled rows, written: every fit reads them, and the sequences, many times as large, are made on the way."""
    return materialize(inputs.select("series_id", "date", "target", "target_center", "target_scale", "is_val_target", "features"))


def _estimator(trial: Trial, seed: int, stop_early: bool = True):
    common = {"featuresCol": "x", "labelCol": "target", "predictionCol": "predicted"}
    if trial.family == "linear":
        return LinearRegression(regParam=trial["reg"], **common)
    if trial.family == "forest":
        return RandomForestRegressor(numTrees=trial["trees"], maxDepth=trial["depth"], seed=seed, **common)
    early = {"validationIndicatorCol": "is_val_target", "validationTol": IMPROVEMENT} if stop_early else {}
    return GBTRegressor(maxIter=trial["iterations"], maxDepth=trial["depth"], seed=seed, **early, **common)


def _fit(trial: Trial, data: DataFrame, seed: int):
    """Boosting stops early on the validation rows; the others see training rows only."""
    rows = data if trial.family == "boosted" else data.where(~F.col("is_val_target"))
    return _estimator(trial, seed).fit(rows)


def pooled_grid(inputs: DataFrame, cfg: ForecastConfig, lists: dict = POOLED_GRID) -> PooledRun:
    """Fit every pooled trial and score it per series on the validation rows."""
    data = vectors(_settled(inputs), cfg)
    val = data.where("is_val_target")
    parts = [
        _fit(t, data, cfg.seed)
        .transform(val)
        .select(
            "series_id", "date", F.col("target").alias("actual"), "target_center", "target_scale",
            F.lit(t.trial_id).alias("trial_id"), F.lit(t.family).alias("family"), F.lit(t.text).alias("params_str"), "predicted",
        )
        for t in grid.expand_families(lists)
    ]
    predictions = reduce(DataFrame.unionByName, parts)
    scores = grid.grid_scores(predictions)
    return PooledRun(predictions, scores, grid.leaderboard(scores), evaluate.smooth_predictions(grid.best_forecast(predictions)))


def loss_curves(inputs: DataFrame, cfg: ForecastConfig, lists: dict = POOLED_GRID) -> DataFrame:
    """Training and validation loss of each iteration of every tree trial, per series.

    ``series_id, trial_id, family, iteration (1-based), train_loss, val_loss``.
    An iteration of boosting adds a tree, one of a forest takes one more tree
    into the mean. Nothing stops early here, so the curves show what comes
    after the best iteration; families without iterations have no curve.
    """
    data = vectors(_settled(inputs), cfg)
    actual, is_val = F.col("target"), F.col("is_val_target")
    parts = []
    for trial in grid.expand_families(lists):
        if trial.family not in ("forest", "boosted"):
            continue
        model = _estimator(trial, cfg.seed, stop_early=False).fit(data.where(~is_val))
        weights = model.treeWeights
        scored, sums, losses = data, F.lit(0.0), []
        for i, (tree, weight) in enumerate(zip(model.trees, weights, strict=True)):
            scored = tree.setFeaturesCol("x").setPredictionCol(f"_tree_{i}").transform(scored)
            sums = sums + F.col(f"_tree_{i}") * weight
            shown = sums / sum(weights[: i + 1]) if trial.family == "forest" else sums
            losses.append(F.struct(mse(F.when(~is_val, actual), shown).alias("train_loss"), mse(F.when(is_val, actual), shown).alias("val_loss")))
        curves = scored.groupBy("series_id").agg(F.array(*losses).alias("curve"))
        parts.append(
            curves.select("series_id", F.posexplode("curve").alias("_i", "loss")).select(
                "series_id",
                F.lit(trial.trial_id).alias("trial_id"),
                F.lit(trial.family).alias("family"),
                (F.col("_i") + 1).alias("iteration"),
                "loss.train_loss",
                "loss.val_loss",
            )
        )
    return reduce(DataFrame.unionByName, parts)
