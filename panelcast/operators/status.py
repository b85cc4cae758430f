"""Why a series did or did not reach the forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelcast.config import ForecastConfig
from panelcast.operators.features import judged
from panelcast.windows import whole


def series_status(series: DataFrame, prepared: DataFrame, cfg: ForecastConfig, variant: str = "full") -> DataFrame:
    """One row per listed series: row counts of each stage and a status, from one pass over the prepared rows.

    The first stage that fails names the status: no_data, a decomposition
    status (not_positive, has_null, too_short), no_features,
    not_enough_train, no_validation, invalid_forecasting_type; else ok.
    """
    # counted over the whole series before the last years are cut out
    rows, _, complete = judged(prepared.withColumn("_days", F.count("close").over(whole())), cfg, variant)
    counts = rows.groupBy("series_id").agg(
        F.max("_days").alias("n_days"), F.max("decompose_status").alias("decompose_status"), F.count_if(complete & F.col("close").isNotNull()).alias("n_features")
    )
    df = series.select("series_id").distinct().join(counts, "series_id", "left")
    df = df.fillna(0, ["n_days", "n_features"])
    train = F.col("n_features") - cfg.horizon - cfg.sequence_length
    status = (
        F.when(F.col("n_days") == 0, "no_data")
        .when(F.col("decompose_status") != "ok", F.col("decompose_status"))
        .when(F.col("n_features") == 0, "no_features")
        .when(F.lit(not cfg.is_one_step), "invalid_forecasting_type")
        .when(train <= 0, "not_enough_train")
        .when(F.lit(cfg.horizon <= 0), "no_validation")
        .otherwise("ok")
    )
    return df.select("series_id", "n_days", "n_features", train.alias("train_size"), status.alias("status"))
