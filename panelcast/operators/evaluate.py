"""Post-processing of forecasts, accuracy and the report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from panelcast.functions.moments import mse, r_squared
from panelcast.operators.scale import inverse_scale
from panelcast.windows import trailing


def smooth_predictions(forecast: DataFrame, n: int = 5) -> DataFrame:
    """Trailing mean of the predictions (fewer rows at the start), actuals untouched,
    both brought back to price units: ``series_id, date, actual, predicted``.
    """
    smooth = F.avg("predicted").over(trailing(n))
    center, scale = F.col("target_center"), F.col("target_scale")
    return forecast.withColumn("predicted", smooth).select(
        "series_id",
        "date",
        inverse_scale(F.col("actual"), center, scale).alias("actual"),
        inverse_scale(F.col("predicted"), center, scale).alias("predicted"),
    )


def residuals(forecast: DataFrame) -> DataFrame:
    return forecast.withColumn("residual", F.col("actual") - F.col("predicted"))


def forecast_counts(targets: DataFrame, forecast: DataFrame) -> DataFrame:
    """Validation targets, predictions and their days of each series: ``series_id, n_targets, n_predictions, n_days``.

    ``targets`` has a row per target. Numbers that differ raise when they are
    read, naming the series.
    """
    wanted = targets.groupBy("series_id").agg(F.count("target").alias("n_targets"))
    got = forecast.groupBy("series_id").agg(F.count("predicted").alias("n_predictions"), F.count_distinct("date").alias("n_days"))
    both = wanted.join(got, "series_id", "full").na.fill(0, ["n_targets", "n_predictions", "n_days"])
    equal = (F.col("n_targets") == F.col("n_predictions")) & (F.col("n_predictions") == F.col("n_days"))
    text = F.concat(F.lit("targets, predictions and days differ in number: "), "series_id", *[x for c in ("n_targets", "n_predictions", "n_days") for x in (F.lit(" "), F.col(c).cast("string"))])
    return both.withColumn("n_targets", F.when(equal, F.col("n_targets")).otherwise(F.raise_error(text).cast("long")))


def forecast_metrics(forecast: DataFrame) -> DataFrame:
    """MSE, RMSE and R² per series in the units of the input."""
    a, p = F.col("actual"), F.col("predicted")
    return forecast.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"), mse(a, p).alias("mse"), F.sqrt(mse(a, p)).alias("rmse"), r_squared(a, p).alias("r2")
    )


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width counts per series, empty bins included, last bin closed.

    ``series_id, bin (1-based), low, high, n``. A constant gets half a unit on
    either side of its value.
    """
    whole = W.partitionBy("series_id")
    x = F.col(value)
    df = df.where(x.isNotNull()).select("series_id", x.alias("_x"))
    df = df.withColumns({"_min": F.min("_x").over(whole), "_max": F.max("_x").over(whole)})
    pad = F.when(F.col("_min") == F.col("_max"), 0.5).otherwise(0.0)
    df = df.withColumns({"_low": F.col("_min") - pad, "_width": (F.col("_max") - F.col("_min") + 2 * pad) / bins})
    df = df.withColumn("_bin", F.least(F.floor((F.col("_x") - F.col("_low")) / F.col("_width")) + 1, F.lit(bins)))
    counts = F.array(*[F.count_if(F.col("_bin") == i) for i in range(1, bins + 1)])
    per_series = df.groupBy("series_id").agg(F.first("_low").alias("_low"), F.first("_width").alias("_width"), counts.alias("_counts"))
    listed = per_series.select("series_id", "_low", "_width", F.posexplode("_counts").alias("_i", "n"))
    return listed.select(
        "series_id",
        (F.col("_i") + 1).alias("bin"),
        (F.col("_low") + F.col("_i") * F.col("_width")).alias("low"),
        (F.col("_low") + (F.col("_i") + 1) * F.col("_width")).alias("high"),
        "n",
    )


def forecast_report(train: DataFrame, forecast: DataFrame) -> DataFrame:
    """Training, actual and predicted prices by date: ``series_id, date, kind, value``.

    ``train`` holds the training targets as ``series_id, date, target``.
    """
    lines = forecast.unpivot(["series_id", "date"], ["actual", "predicted"], "kind", "value")
    return train.select("series_id", "date", F.lit("train").alias("kind"), F.col("target").alias("value")).unionByName(lines)
