"""A panel that grows by new days without reading its history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelcast.functions.dates import calendar_columns
from panelcast.operators.combine import combine
from panelcast.operators.panel import densify
from panelcast.schema import macro_columns

_CALENDAR = ["year", "month", "quarter", "day_name"]


def panel_state(panel: DataFrame, last_day: Column) -> DataFrame:
    """What later days need of a panel: each series' row of its last day."""
    return panel.where(F.col("date") == last_day).drop(*_CALENDAR)


def extend_panel(state: DataFrame, bars: DataFrame, macro: DataFrame, start: Column, last_day: Column, end: Column) -> DataFrame:
    """The panel's rows that a load up to ``end`` adds to one up to ``last_day``.

    ``state`` comes from ``panel_state``, ``bars`` are the bars after
    ``last_day``, ``macro`` is ``routed_macro`` with all quarters (one row per
    series and quarter, not a history of days). Series of the state go on from
    their last values; one whose first bar is new gets its rows from ``start``
    on, as a load of everything would give it.
    """
    new = bars.where((F.col("date") > last_day) & (F.col("date") <= end))
    known = state.select("series_id")
    first = combine(new.join(known, "series_id", "left_anti"), macro, start, end)
    values = [c for c in state.columns if c not in ("series_id", "date", "n_areas")]
    side = state.withColumn("_layer", F.lit(-1))
    old_macro = macro.where((F.col("date") > last_day) & (F.col("date") <= end)).join(known, "series_id", "left_semi")
    old_macro = old_macro.withColumn("_layer", F.col("pos") + 1).drop("pos", "obs_year", "obs_quarter", "n_areas")
    stacked = side.unionByName(new.join(known, "series_id", "left_semi").withColumn("_layer", F.lit(0)), allowMissingColumns=True)
    stacked = stacked.unionByName(old_macro, allowMissingColumns=True).drop("n_areas").select("series_id", "date", "_layer", *values)
    days = densify(stacked, last_day, end, layer="_layer", fill=True).where(F.col("date") > last_day)
    days = calendar_columns(days.join(state.select("series_id", "n_areas"), "series_id"))
    head = ["series_id", "date", *_CALENDAR]
    rest = [c for c in days.columns if c not in head and c not in macro_columns(days) and c != "n_areas"]
    return days.select(*head, *rest, *macro_columns(days), "n_areas").unionByName(first)
