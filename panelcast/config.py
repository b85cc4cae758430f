"""Settings shared by the feature, split and grid-search steps."""

from __future__ import annotations

from dataclasses import dataclass, field

# Tier-A grid: per family, the parameter lists. Families are unioned, never
# multiplied with each other; within a family the last key varies fastest.
DEFAULT_GRID: dict[str, dict[str, list]] = {
    "naive": {"k": [1, 7, 14]},
    "moving_average": {"w": [3, 5, 7, 14]},
    "ols_lag": {"k": [1, 2, 7, 14]},
}

ONE_STEP = ("one_step", "recursive")


@dataclass(frozen=True)
class ForecastConfig:
    """Defaults follow the function signature of the pipeline being matched.

    ``forecasting_type`` accepts ``one_step`` and its historic alias
    ``recursive``: each validation day is predicted from actual past rows,
    predictions are never fed back.
    """

    sequence_length: int = 14
    scaling_method: str = "standard"
    forecasting_type: str = "one_step"
    n_years: int = 6
    horizon: int = 180
    short_lag: int = 60
    long_lag: int = 360
    k_best: int = 10
    period: int = 252
    theta: float = 0.1
    seed: int = 42
    select_on: str = "all"
    grid: dict[str, dict[str, list]] = field(default_factory=lambda: DEFAULT_GRID)

    @property
    def is_one_step(self) -> bool:
        return self.forecasting_type in ONE_STEP

    @property
    def lag_columns(self) -> list[str]:
        return [f"close_lag_{self.short_lag}", f"close_lag_{self.long_lag}"]


# The settings the pipeline's own main program uses.
MAIN_CONFIG = ForecastConfig(horizon=30, short_lag=7, long_lag=30, k_best=8)
