"""Multiplicative seasonal decomposition by centred moving average."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from panelcast.windows import by_date, running, whole

SCALARS = ["_pos", "_n", "_missing", "_low", "_mean", "_total", "_sd", "last_day"]


def with_scalars(panel: DataFrame, value: str = "close") -> DataFrame:
    """Adds row position and the per-series totals later steps need, in one pass."""
    x = F.col(value)
    return panel.withColumns(
        {
            "_pos": F.row_number().over(by_date()) - 1,
            "_n": F.count(F.lit(1)).over(whole()),
            "_missing": F.count_if(x.isNull()).over(whole()),
            "_low": F.min(x).over(whole()),
            "_mean": F.avg(x).over(whole()),
            "_total": F.sum(x).over(whole()),
            "_sd": F.stddev_samp(x).over(whole()),
            "last_day": F.max("date").over(whole()),
        }
    )


def deviation_sum(value: str = "close") -> Column:
    """Running sum of deviations from the series mean; needs ``with_scalars``."""
    return F.sum(F.col(value) - F.col("_mean")).over(running())


def with_components(df: DataFrame, value: str = "close", period: int = 252) -> DataFrame:
    """Adds trend, seasonal, resid and decompose_status to a frame that has the
    ``with_scalars`` columns and ``_sum`` (``deviation_sum``).

    The windows by phase come last, so that a later date filter runs before
    the rows are sorted by date again.
    """
    x, half = F.col(value), period // 2
    status = (
        F.when(F.col("_missing") > 0, "has_null")
        .when(F.col("_low") <= 0, "not_positive")
        .when(F.col("_n") < 2 * period, "too_short")
        .otherwise("ok")
    )
    moving = F.lead("_sum", half).over(by_date()) - F.coalesce(F.lag("_sum", half + 1).over(by_date()), F.lit(0.0))
    if period % 2 == 0:
        ends = F.lag(value, half).over(by_date()) + F.lead(value, half).over(by_date())
        moving = moving - (ends / 2 - F.col("_mean"))
    df = df.withColumns({"decompose_status": status, "_moving": moving, "_phase": F.col("_pos") % period})
    inside = (F.col("_pos") >= half) & (F.col("_pos") < F.col("_n") - half) & (F.col("decompose_status") == "ok")
    df = df.withColumn("trend", F.when(inside, F.col("_mean") + F.col("_moving") / period))
    df = df.withColumn("_factor", F.avg(F.try_divide(x, F.col("trend"))).over(W.partitionBy("series_id", "_phase")))
    # Each phase counts once: the first cycle holds every phase exactly once.
    df = df.withColumn("_level", F.avg(F.when(F.col("_pos") < period, F.col("_factor"))).over(W.partitionBy("series_id")))
    df = df.withColumn("seasonal", F.try_divide(F.col("_factor"), F.col("_level")))
    df = df.withColumn("resid", F.try_divide(x, F.col("trend") * F.col("seasonal")))
    return df.drop("_moving", "_phase", "_factor", "_level")


def decompose(panel: DataFrame, value: str = "close", period: int = 252) -> DataFrame:
    """Adds trend, seasonal, resid and decompose_status.

    trend: mean over ``period`` days centred on the row; an even period takes
    period+1 days with half weight on the two ends. seasonal: mean of
    value/trend per phase (position modulo period), scaled to mean 1 over one
    cycle. resid: value / (trend * seasonal). A series with a non-positive or
    missing value, or shorter than two cycles, gets NULLs and a status.

    The moving sum is the difference of two running sums of deviations from
    the series mean, so the work per row does not depend on the period.
    """
    df = with_scalars(panel, value).withColumn("_sum", deviation_sum(value))
    return with_components(df, value, period).drop("_sum", *SCALARS)


def seasonal_adjust(decomposed: DataFrame, value: str = "close") -> DataFrame:
    """Adds value / seasonal."""
    return decomposed.withColumn(f"seasonal_adjusted_{value}", F.try_divide(F.col(value), F.col("seasonal")))


def decomposition_long(decomposed: DataFrame, value: str = "close") -> DataFrame:
    """The four components as ``series_id, date, component, value``."""
    return decomposed.withColumn("observed", F.col(value)).unpivot(
        ["series_id", "date"], ["observed", "trend", "seasonal", "resid"], "component", "value"
    )
