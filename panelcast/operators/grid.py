"""Trial grids and the SQL-only forecaster families, scored in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from panelcast.functions.moments import mse, r_squared
from panelcast.operators.scale import scaler
from panelcast.operators.split import is_train_row, is_train_target, is_val_target
from panelcast.operators.stats import numbered
from panelcast.windows import by_date, whole, before


@dataclass(frozen=True)
class Trial:
    trial_id: int
    family: str
    params: tuple[tuple[str, object], ...]

    @property
    def text(self) -> str:
        return "; ".join(f"{k}: {v}" for k, v in self.params)

    def __getitem__(self, key: str):
        return dict(self.params)[key]


def expand_product(grid: Mapping[str, Sequence], family_key: str) -> list[Trial]:
    """Every combination in key order, the last key varying fastest."""
    keys = list(grid)
    rows = [tuple(zip(keys, values)) for values in product(*grid.values())]
    return [Trial(i, str(dict(r)[family_key]), r) for i, r in enumerate(rows)]


def expand_families(grid: Mapping[str, Mapping[str, Sequence]]) -> list[Trial]:
    """The union of each family's own product, numbered in order."""
    rows = [
        (family, tuple([("family", family), *zip(lists, values)]))
        for family, lists in grid.items()
        for values in product(*lists.values())
    ]
    return [Trial(i, family, params) for i, (family, params) in enumerate(rows)]


def _trial_columns(trial: Trial) -> list[Column]:
    params = F.create_map(*[F.lit(str(x)) for pair in trial.params for x in pair])
    return [
        F.lit(trial.trial_id).alias("trial_id"),
        F.lit(trial.family).alias("family"),
        params.alias("params"),
        F.lit(trial.text).alias("params_str"),
    ]


def trials_per_series(series: DataFrame, trials: Sequence[Trial]) -> DataFrame:
    """``series_id, trial_id, family, params, params_str`` from a plan-time grid."""
    listed = F.array(*[F.struct(*_trial_columns(t)) for t in trials])
    return series.select("series_id").distinct().select("series_id", F.inline(listed))


def _prediction(trial: Trial) -> Column:
    if trial.family == "naive":
        return F.col(f"_lag_{trial['k']}")
    if trial.family == "moving_average":
        return F.col(f"_ma_{trial['w']}")
    if trial.family == "ols_lag":
        k = trial["k"]
        return F.col(f"_my_{k}") + F.col(f"_b_{k}") * (F.col(f"_lag_{k}") - F.col(f"_mx_{k}"))
    raise ValueError(f"unknown family {trial.family!r}")


def grid_predictions(frame: DataFrame, trials: Sequence[Trial], horizon: int, length: int) -> DataFrame:
    """One-step predictions of every trial on the validation rows, scaled units.

    ``frame`` needs ``series_id, date, target``. All lags and trailing means
    are one window pass, the target's scaler and all least-squares lines a
    second one; only the ``horizon`` validation rows of a series are then
    listed once per trial. The families are linear in the target, so they are
    evaluated in price units and scaled afterwards. Keeps
    ``target_center``/``target_scale`` for the inverse.
    """
    ols = sorted({t["k"] for t in trials if t.family == "ols_lag"})
    lags = sorted({t["k"] for t in trials if t.family == "naive"} | set(ols))
    widths = sorted({t["w"] for t in trials if t.family == "moving_average"})
    if max(lags + widths) > length:
        raise ValueError("a trial looks back further than sequence_length")

    past = {f"_lag_{k}": F.lag("target", k).over(by_date()) for k in lags}
    past |= {f"_ma_{w}": F.avg("target").over(before(w)) for w in widths}
    df = numbered(frame.select("series_id", "date", "target"), past).where(F.col("n") - horizon - length > 0)

    train, fit_row = is_train_row(horizon), is_train_target(horizon, length)
    y = F.when(fit_row, F.col("target"))
    center, size = scaler("standard")(F.when(train, F.col("target")), lambda c: c.over(whole()))
    state = {"target_center": center, "target_scale": size}
    for k in ols:
        x = F.when(fit_row, F.col(f"_lag_{k}"))
        slope = F.try_divide(F.covar_pop(y, x).over(whole()), F.var_pop(x).over(whole()))
        state |= {f"_b_{k}": F.coalesce(slope, F.lit(0.0)), f"_my_{k}": F.avg(y).over(whole()), f"_mx_{k}": F.avg(x).over(whole())}
    df = df.withColumns(state).where(is_val_target(horizon))

    scaled = lambda c: (c - F.col("target_center")) / F.col("target_scale")
    listed = F.array(
        *[
            F.struct(
                F.lit(t.trial_id).alias("trial_id"),
                F.lit(t.family).alias("family"),
                F.lit(t.text).alias("params_str"),
                scaled(_prediction(t)).alias("predicted"),
            )
            for t in trials
        ]
    )
    return df.select("series_id", "date", scaled(F.col("target")).alias("actual"), "target_center", "target_scale", F.inline(listed))


def grid_scores(predictions: DataFrame) -> DataFrame:
    """Validation loss and R² per series and trial, scaled and unsmoothed."""
    a, p = F.col("actual"), F.col("predicted")
    return predictions.groupBy("series_id", "trial_id", "family", "params_str").agg(
        mse(a, p).alias("val_loss"), r_squared(a, p).alias("val_r2")
    )


def _ranked(scores: DataFrame, *by: str) -> DataFrame:
    order = W.partitionBy(*by).orderBy("val_loss", "trial_id")
    return scores.withColumn("rank", F.row_number().over(order))


def best_per_family(scores: DataFrame) -> DataFrame:
    """The lowest loss of each family; the earlier trial wins a tie."""
    return _ranked(scores, "series_id", "family").where(F.col("rank") == 1).drop("rank")


def best_trial(scores: DataFrame) -> DataFrame:
    return _ranked(scores, "series_id").where(F.col("rank") == 1).drop("rank")


def leaderboard(scores: DataFrame) -> DataFrame:
    """Ranked trials of each series with MSE, RMSE and R²."""
    return _ranked(scores, "series_id").select(
        "series_id",
        "rank",
        F.col("params_str").alias("parameters"),
        F.col("val_loss").alias("mean_mse"),
        F.sqrt("val_loss").alias("rmse"),
        F.col("val_r2").alias("r2"),
    )


def best_iteration(curves: DataFrame) -> DataFrame:
    """The lowest validation loss along each trial's loss curve, first one on ties."""
    order = W.partitionBy("series_id", "trial_id").orderBy("val_loss", "iteration")
    return (
        curves.withColumn("_nth", F.row_number().over(order))
        .where(F.col("_nth") == 1)
        .select("series_id", "trial_id", F.col("iteration").alias("best_iteration"), F.col("val_loss").alias("best_loss"))
    )


def best_forecast(predictions: DataFrame) -> DataFrame:
    """The best trial's predictions, found and kept in one pass over them."""
    per_trial = W.partitionBy("series_id", "trial_id")
    loss = mse(F.col("actual"), F.col("predicted"), lambda c: c.over(per_trial))
    ranked = predictions.withColumn("_key", F.struct(loss.alias("loss"), F.col("trial_id").alias("trial")))
    best = ranked.withColumn("_best", F.min("_key").over(W.partitionBy("series_id")))
    return best.where(F.col("_key") == F.col("_best")).drop("_key", "_best")
