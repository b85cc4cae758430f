"""Per-day features and the supervised feature frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from panelcast.config import ForecastConfig
from panelcast.functions.dates import seasonal_columns, years_before
from panelcast.functions.noise import day_number, gaussian
from panelcast.operators.decompose import SCALARS, deviation_sum, seasonal_adjust, with_components, with_scalars
from panelcast.schema import macro_columns, require_columns
from panelcast.windows import by_date, running, whole, trailing

SEASONAL_COLUMNS = ["month", "day_of_week", "quarter", "sin_month", "cos_month"]
STOCHASTIC_COLUMNS = ["entropy", "random_component", "ou_simulated"]


#: A series' entropy and noise columns have values, all or none: it has two rows and a total.
NOISY = "has_noise"


def last_n_years(panel: DataFrame, n_years: int = 6) -> DataFrame:
    """Rows of each series' last n years, both ends included.

    A ``last_day`` column, as ``prepare`` leaves it, is used when present.
    """
    if "last_day" not in panel.columns:
        panel = panel.withColumn("last_day", F.max("date").over(whole()))
    return panel.where(F.col("date") >= years_before(F.col("last_day"), n_years)).drop("last_day")


def lag_features(panel: DataFrame, lags: Sequence[int], value: str = "close") -> DataFrame:
    return panel.withColumns({f"{value}_lag_{k}": F.lag(value, k).over(by_date()) for k in lags})


def moving_average(panel: DataFrame, n: int = 5, value: str = "close", name: str | None = None) -> DataFrame:
    """Trailing mean of n rows; NULL unless all n hold a value."""
    frame = trailing(n)
    full = F.count(value).over(frame) == n
    return panel.withColumn(name or f"ma_{n}", F.when(full, F.avg(value).over(frame)))


def close_moments(panel: DataFrame, value: str = "close") -> DataFrame:
    """Count, sum, mean and sample standard deviation per series."""
    return panel.groupBy("series_id").agg(
        F.count(value).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )


def _entropy(value: str) -> Column:
    share = F.try_divide(F.col(value), F.col("_total"))
    return -F.sum(share * F.log2(share + F.lit(1e-10))).over(whole())


def price_entropy(panel: DataFrame, value: str = "close") -> DataFrame:
    """Adds each series' Shannon entropy of its price shares, in bits."""
    return panel.withColumn("_total", F.sum(value).over(whole())).withColumn("entropy", _entropy(value)).drop("_total")


def _draw(seed: int, name: str) -> Column:
    return gaussian(seed, name, F.col("series_id"), day_number(F.col("date")))


def random_component(panel: DataFrame, seed: int = 42, value: str = "close") -> DataFrame:
    """Adds N(0, sample std of the series) noise, one draw per series and day."""
    return panel.withColumn("random_component", _draw(seed, "random") * F.stddev_samp(value).over(whole()))


def _ou_step(theta: float, horizon: float) -> Column:
    """a = 1 - theta dt, with dt = horizon / rows of the series."""
    return 1 - theta * (F.lit(horizon) / F.col("_n"))


def _ou_path(theta: float, horizon: float, seed: int) -> Column:
    """Running sum of z[s] a^-s over 0 < s <= t."""
    if not 0 <= theta * horizon <= 500:
        raise ValueError("theta * horizon must lie in 0..500 for the closed form to stay in double range")
    term = _draw(seed, "ou") * F.pow(_ou_step(theta, horizon), -F.col("_pos"))
    return F.sum(F.when(F.col("_pos") > 0, term).otherwise(0.0)).over(running())


def _ou_value(theta: float, horizon: float) -> Column:
    spread = F.col("_sd") * F.sqrt(F.lit(horizon) / F.col("_n")) * F.pow(_ou_step(theta, horizon), F.col("_pos"))
    return F.col("_mean") + F.when(F.col("_pos") > 0, spread * F.col("_path")).otherwise(0.0)


def ou_noise(panel: DataFrame, theta: float = 0.1, horizon: float = 1.0, seed: int = 42, value: str = "close") -> DataFrame:
    """Adds a mean-reverting path x0 = mu, x[t] = a x[t-1] + (1-a) mu + sigma sqrt(dt) z[t].

    The recurrence is solved in closed form, x[t] = mu + sigma sqrt(dt) a^t
    sum_{0<s<=t} z[s] a^-s, so one running sum replaces the row loop.
    """
    df = with_scalars(panel, value).withColumn("_path", _ou_path(theta, horizon, seed))
    return df.withColumn("ou_simulated", _ou_value(theta, horizon)).drop("_path", *SCALARS)


def prepare(panel: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Full-history features: decomposition, calendar, entropy, noise, adjustment.

    Expects a filled panel, in which a series' only missing closes are the days
    before its first one; those are dropped. The result keeps ``last_day``, and
    in ``has_noise`` whether a series' entropy and noise columns have values.

    The separate operators are fused here: one pass for the per-series
    scalars and one for all running sums and the entropy.
    """
    require_columns(panel, ["series_id", "date", "close"])
    df = with_scalars(panel.where(F.col("close").isNotNull()))
    df = df.withColumn("random_component", _draw(cfg.seed, "random") * F.col("_sd"))
    df = df.withColumns({"_sum": deviation_sum(), "entropy": _entropy("close"), "_path": _ou_path(cfg.theta, 1.0, cfg.seed)})
    df = df.withColumn("ou_simulated", _ou_value(cfg.theta, 1.0))
    df = df.withColumn(NOISY, F.col("_sd").isNotNull() & (F.col("_total") != 0))
    df = seasonal_adjust(with_components(df, period=cfg.period))
    helpers = [c for c in SCALARS if c != "last_day"]
    return seasonal_columns(df).drop("_sum", "_path", "trend", "seasonal", "resid", *helpers)


def present_macro(df: DataFrame) -> list[Column]:
    """Per macro column: it has a value, or the series has no such area."""
    width = F.col("n_areas") if "n_areas" in df.columns else None
    return [
        F.col(c).isNotNull() | (width <= i) if width is not None else F.col(c).isNotNull()
        for i, c in enumerate(macro_columns(df))
    ]


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def lagged(prepared: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Last n years with lags and the 5-day mean taken inside that range."""
    recent = last_n_years(prepared, cfg.n_years)
    return moving_average(lag_features(recent, [cfg.short_lag, cfg.long_lag]), 5)


def feature_names(df: DataFrame, cfg: ForecastConfig, variant: str = "full") -> list[str]:
    names = cfg.lag_columns + ["ma_5"]
    if variant in ("full", "strict"):
        names += SEASONAL_COLUMNS + STOCHASTIC_COLUMNS
    if variant == "full":
        names += ["seasonal_adjusted_close"]
    return [c for c in names if c in df.columns] + macro_columns(df)


def judged(prepared: DataFrame, cfg: ForecastConfig, variant: str = "full") -> tuple[DataFrame, list[str], Column]:
    """The rows of the last n years with all features, the features' names, and which rows are complete."""
    df = lagged(prepared, cfg)
    names = feature_names(df, cfg, variant)
    macros = set(macro_columns(df))
    checked = names if variant == "full" else [c for c in df.columns if c not in ("n_areas", "decompose_status", NOISY)]
    complete = []
    if NOISY in df.columns:  # asked of the series, so that readers of other columns need no draws
        complete = [F.col(NOISY)] if set(STOCHASTIC_COLUMNS) & set(checked) else []
        checked = [c for c in checked if c not in STOCHASTIC_COLUMNS]
    complete += [F.col(c).isNotNull() for c in checked if c not in macros] + present_macro(df)
    return df, names, _all(complete)


def feature_frame(prepared: DataFrame, cfg: ForecastConfig, variant: str = "full") -> DataFrame:
    """``series_id, date, features…, [n_areas], target``, warm-up rows removed.

    ``full`` drops rows with a missing expected feature; ``strict`` (no
    adjusted close) and ``basic`` (lags, mean and macro only) drop rows with
    any missing column.
    """
    df, names, complete = judged(prepared, cfg, variant)
    extra = ["n_areas"] if "n_areas" in df.columns else []
    return df.where(complete).select("series_id", "date", *names, *extra, F.col("close").alias("target"))
