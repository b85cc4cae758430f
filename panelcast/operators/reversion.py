"""Estimation of a mean-reverting process from unevenly spaced observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelcast.windows import by_date, whole


def mean_reversion(rows: DataFrame, value: str = "close") -> DataFrame:
    """Speed, level and volatility of each series: ``series_id, n, theta, mean, sigma, half_life``.

    From one observation to the next, d days later, the process moves by
    theta (mean - x) d on average, with variance sigma^2 d. Steps weighted by
    1 / d make that a least-squares line of the step on (d, x d) without a
    constant, so gaps of any length count as what they are; all that it needs
    is one row of sums per series. ``n`` counts steps, theta is per day, and
    half_life (days) is NULL unless theta is positive. Rows without a date or
    value are no observations; NULLs where fewer than three steps, or a
    constant series, fix no line.
    """
    seen = rows.select("series_id", "date", F.col(value).cast("double").alias("x")).where(F.col("date").isNotNull() & F.col("x").isNotNull())
    level = F.avg("x").over(whole())  # taken off, so that the sums keep their digits
    seen = seen.withColumns({"level": level, "before": F.lag("x").over(by_date()), "d": F.datediff("date", F.lag("date").over(by_date())).cast("double")})
    steps = seen.where(F.col("d") > 0).select("series_id", "level", "d", (F.col("before") - F.col("level")).alias("x"), (F.col("x") - F.col("before")).alias("s"))
    x, d, s = F.col("x"), F.col("d"), F.col("s")
    sums = steps.groupBy("series_id").agg(
        F.first("level").alias("level"), F.count(F.lit(1)).alias("n"), F.sum(d).alias("d"), F.sum(x * d).alias("xd"), F.sum(x * x * d).alias("xxd"),
        F.sum(s).alias("s"), F.sum(x * s).alias("xs"), F.sum(s * s / d).alias("ss"),
    )
    c = F.col
    determinant = c("d") * c("xxd") - c("xd") * c("xd")
    fixed = (c("n") > 2) & (determinant > 1e-12 * c("d") * c("xxd"))
    sums = sums.withColumn("slope", F.when(fixed, F.try_divide(c("d") * c("xs") - c("xd") * c("s"), determinant)))
    sums = sums.withColumn("base", (c("s") - c("slope") * c("xd")) / c("d"))
    theta = -c("slope")
    rest = F.greatest(F.lit(0.0), c("ss") - c("base") * c("s") - c("slope") * c("xs"))
    return sums.select(
        "series_id", "n", theta.alias("theta"), (c("level") + F.try_divide(c("base"), theta)).alias("mean"),
        F.when(fixed, F.sqrt(rest / (c("n") - 2))).alias("sigma"), F.when(theta > 0, F.log(F.lit(2.0)) / theta).alias("half_life"),
    )
