"""The forecasting pipeline as one lazy plan over all series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from panelcast.config import ForecastConfig
from panelcast.operators import evaluate, grid, linear, scale, split, stats
from panelcast.operators.features import feature_frame, feature_names, prepare
from panelcast.session import materialize, stored


@dataclass(frozen=True)
class ForecastPlan:
    """Lazy result tables of one run."""

    frame: DataFrame
    predictions: DataFrame
    scores: DataFrame
    leaderboard: DataFrame
    best: DataFrame
    best_per_family: DataFrame
    forecast: DataFrame
    metrics: DataFrame
    residuals: DataFrame
    residual_histogram: DataFrame
    report: DataFrame


def scaled_inputs(frame: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Model inputs: the k best features, split, scaled on the training rows.

    ``series_id, date, target, target_center, target_scale, split flags,
    selected ARRAY, features ARRAY``; ``selected`` holds feature positions.
    Features are scaled after the selection, so only k columns are.
    """
    names = feature_names(frame, cfg)
    flags = ["is_train", "is_val", "is_train_target", "is_val_target"]
    df = split.train_val_split(frame, cfg.horizon, cfg.sequence_length)
    on = F.col("is_train") if cfg.select_on == "train" else None
    df = stats.project_selected(stats.with_selection(df, names, cfg.k_best, on=on), names, ["target", *flags], min(cfg.k_best, len(names)))
    slots = [f"f{i}" for i in range(min(cfg.k_best, len(names)))]
    df = df.select("*", *[F.get("features", F.lit(i)).alias(c) for i, c in enumerate(slots)])
    if scale.is_standard(cfg.scaling_method):
        df = scale.with_state(df, ["target", *slots], "standard", F.col("is_train"))
    else:
        df = scale.with_state(scale.with_state(df, slots, cfg.scaling_method, F.col("is_train")), ["target"], "standard", F.col("is_train"))
    df = scale.apply_scaler(df, ["target", *slots], keep_state=["target"])
    # A series with fewer features than slots has NULL in the last ones.
    scaled = F.slice(F.array(*slots), F.lit(1), F.size("selected"))
    return df.withColumn("features", scaled).drop(*slots)


def learned_scores(frame: DataFrame, cfg: ForecastConfig, first_id: int) -> DataFrame:
    """Ridge trials and the trained grid, early stopped, numbered from ``first_id``."""
    inputs = stored(scaled_inputs(frame, cfg), "inputs")
    ridge = linear.ridge_scores(inputs, cfg)
    trained = linear.trained_scores(linear.early_stopping(linear.trained_curves(inputs, cfg)), inputs)
    after = len(grid.expand_families(linear.RIDGE_GRID))
    return ridge.unionByName(trained.withColumn("trial_id", F.col("trial_id") + after)).withColumn("trial_id", F.col("trial_id") + first_id)


def forecast_panel(panel: DataFrame, cfg: ForecastConfig = ForecastConfig(), reuse: bool = False, learned: bool = False) -> ForecastPlan:
    """Features, grid search and evaluation for every series of a combined panel.

    Nothing runs until a table is read. With ``reuse`` the feature frame is
    checkpointed first, for callers who read several of the tables. With
    ``learned`` the scores, the leaderboard and the best trials include the
    ridge trials and the trained grid, which are fitted at once; forecasts and
    what follows from them stay those of the best SQL family.
    """
    if not cfg.is_one_step:
        raise ValueError(f"unknown forecasting type {cfg.forecasting_type!r}")
    frame = feature_frame(prepare(panel, cfg), cfg)
    if reuse or learned:
        frame = materialize(frame)
    predictions = grid.grid_predictions(frame, grid.expand_families(cfg.grid), cfg.horizon, cfg.sequence_length)
    scores = grid.grid_scores(predictions)
    if learned:
        scores = scores.unionByName(learned_scores(frame, cfg, len(grid.expand_families(cfg.grid))))
    forecast = evaluate.smooth_predictions(grid.best_forecast(predictions))
    train = split.train_val_split(frame, cfg.horizon, cfg.sequence_length).where("is_train_target")
    residuals = evaluate.residuals(forecast)
    return ForecastPlan(
        frame=frame,
        predictions=predictions,
        scores=scores,
        leaderboard=grid.leaderboard(scores),
        best=grid.best_trial(scores),
        best_per_family=grid.best_per_family(scores),
        forecast=forecast,
        metrics=evaluate.forecast_metrics(forecast),
        residuals=residuals,
        residual_histogram=evaluate.histogram(residuals, "residual"),
        report=evaluate.forecast_report(train, forecast),
    )
