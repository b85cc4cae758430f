"""Daily panel of bars and macro indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from panelcast.functions.dates import calendar_columns
from panelcast.operators.panel import calendar_bounds, densify
from panelcast.schema import macro_columns


def combine(bars: DataFrame, macro: DataFrame, start: str | Column | None = None, end: str | Column | None = None, tasks: int | None = None) -> DataFrame:
    """Bars and macro rows -> one filled row per series and day.

    ``macro`` is ``routed_macro`` (a row per area, none aggregated) or
    ``series_macro``. Densifying and filling both sides, joining them on the
    date and filling again gives, for every column, its last value so far;
    stacking the sparse rows and filling once gives the same rows from a single
    shuffle of observed rows. Series missing on either side drop out. The
    calendar runs from the first to the last bar unless days are given.
    ``tasks`` is the number of parts of that shuffle, where the caller knows
    how many days will fill them.
    """
    side = F.col("_layer")
    lo, hi = calendar_bounds(bars, start, end)
    # The order densify uses, so both windows share one sort.
    both = W.partitionBy("series_id").orderBy(F.col("date").asc_nulls_last(), side).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    layer = F.col("pos") + 1 if "pos" in macro.columns else F.lit(1)
    stacked = (
        bars.where(F.col("date").between(lo, hi))
        .withColumn("_layer", F.lit(0))
        .unionByName(macro.withColumn("_layer", layer).drop("pos"), allowMissingColumns=True)
    )
    if tasks:
        stacked = stacked.repartition(tasks, "series_id")
    stacked = (
        stacked.withColumns(
            {
                "_priced": F.max(side == 0).over(both),
                "n_areas": F.max("n_areas").over(both),
            }
        )
        .where(F.col("_priced") & F.col("n_areas").isNotNull())
        .drop("_priced")
    )
    panel = densify(stacked.drop("obs_year", "obs_quarter"), lo, hi, layer="_layer", carry=["n_areas"], fill=True)
    panel = calendar_columns(panel)
    head = ["series_id", "date", "year", "month", "quarter", "day_name"]
    rest = [c for c in panel.columns if c not in head and c not in macro_columns(panel) and c != "n_areas"]
    return panel.select(*head, *rest, *macro_columns(panel), "n_areas")
