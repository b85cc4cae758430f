"""Time-series panel analytics on Spark: one long frame, all series at once."""

from panelcast.config import ForecastConfig
from panelcast.plans.forecast import ForecastPlan, forecast_panel

__all__ = ["ForecastConfig", "ForecastPlan", "forecast_panel"]
