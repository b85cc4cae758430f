"""Slow macro observations: parsing, pivoting, routing to series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelcast.functions.dates import lenient_double, quarter_start
from panelcast.operators.panel import densify
from panelcast.schema import AREA_MAP, macro_columns

# Shares in which the quarters of an area are joined to the series.
SHARES = 16


def complete_observations(raw: DataFrame) -> DataFrame:
    """Text observations with a value, a period and an area."""
    present = [(F.col(c).isNotNull()) & (F.col(c) != "") for c in ("value", "period", "area")]
    return raw.where(present[0] & present[1] & present[2])


def parse_periods(raw: DataFrame) -> DataFrame:
    """Adds date, year, quarter and rejected; malformed periods are flagged, not fatal."""
    date = quarter_start(F.col("period"))
    return raw.withColumns(
        {"date": date, "year": F.year(date), "quarter": F.quarter(date), "rejected": date.isNull()}
    )


def parse_macro(raw: DataFrame) -> DataFrame:
    """Text observations -> ``date, year, quarter, area, value``.

    Rows whose period or number does not parse are dropped; a NaN is kept as
    NULL.
    """
    good = parse_periods(complete_observations(raw)).where(~F.col("rejected"))
    good = good.where(F.col("value").try_cast("double").isNotNull())
    return good.select("date", "year", "quarter", "area", lenient_double(F.col("value")).alias("value"))


def request(obs: DataFrame, areas: Sequence[str], start_period: str) -> DataFrame:
    """The observations a data request for these areas since that quarter returns."""
    since = quarter_start(F.lit(start_period))
    return obs.where(F.col("area").isin(list(areas)) & (F.col("date") >= since))


def pivot_areas(obs: DataFrame, areas: Sequence[str] | None = None) -> DataFrame:
    """One row per quarter, one ``macro_{area}`` column per area (all, or those listed), duplicates averaged."""
    wide = obs.groupBy("date", "year", "quarter").pivot("area", None if areas is None else sorted(areas)).agg(F.avg("value"))
    return wide.withColumnsRenamed({a: "macro_" + a.replace(" ", "_") for a in wide.columns[3:]})


def area_map(spark, mapping: dict[str, list[str]]) -> DataFrame:
    rows = [(s, a, i) for s, areas in mapping.items() for i, a in enumerate(areas)]
    return spark.createDataFrame(rows, AREA_MAP)


def with_base_area(mapping: DataFrame, base: str, series: DataFrame | None = None) -> DataFrame:
    """The map with the base area put first for every series that lacks it.

    Adds ``n_areas``, the length of each series' list. With ``series`` (rows
    with a series_id) those that the map does not name get the base area alone.
    """
    areas = F.transform(F.array_sort(F.collect_list(F.struct("pos", "area"))), lambda x: x["area"])
    lists = mapping.groupBy("series_id").agg(areas.alias("areas"))
    if series is not None:
        lists = lists.join(series.select("series_id").distinct(), "series_id", "full")
        lists = lists.withColumn("areas", F.coalesce("areas", F.array().cast("array<string>")))
    full = F.when(F.array_contains("areas", base), F.col("areas")).otherwise(F.concat(F.array(F.lit(base)), F.col("areas")))
    lists = lists.select("series_id", full.alias("areas")).withColumn("n_areas", F.size("areas"))
    return lists.select("series_id", "n_areas", F.posexplode("areas").alias("pos", "area"))


def missing_areas(mapping: DataFrame, obs: DataFrame) -> DataFrame:
    """Mapped areas that have no observation at all."""
    return mapping.join(obs.select("area").distinct(), "area", "left_anti").select("series_id", "area", "pos")


def map_width(mapping: DataFrame) -> int:
    """Areas of the series that has most."""
    return mapping.agg(F.max("n_areas")).first()[0] or 0


def routed_macro(mapping: DataFrame, obs: DataFrame, width: int | None = None) -> DataFrame:
    """``series_id, n_areas, pos, date, obs_year, obs_quarter, macro_0..``: a row per series, area and quarter.

    ``mapping`` comes from ``with_base_area``; ``width`` is its longest list,
    measured unless given, and a longer list raises. Only the column of a row's
    own position has a value. An area that very many series share is joined
    in shares: a copy of the quarters for each.
    """
    width = map_width(mapping) if width is None else width
    quarters = obs.groupBy("area", "date", "year", "quarter").agg(F.avg("value").alias("value"))
    quarters = quarters.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    shared = mapping.withColumn("_share", F.pmod(F.xxhash64("series_id"), F.lit(SHARES)).cast("int"))
    routed = shared.join(quarters, ["area", "_share"], "left")
    too_long = F.when(F.col("n_areas") > width, F.raise_error(F.concat(F.lit("more areas than columns: "), "series_id")).cast("int"))
    own = [F.when(F.col("pos") == i, F.col("value")).alias(f"macro_{i}") for i in range(width)]
    return routed.select("series_id", F.coalesce(too_long, "n_areas").alias("n_areas"), "pos", "date", F.col("year").alias("obs_year"), F.col("quarter").alias("obs_quarter"), *own)


def series_macro(mapping: DataFrame, obs: DataFrame, width: int | None = None) -> DataFrame:
    """Sparse wide rows ``series_id, date, n_areas, obs_year, obs_quarter, macro_0..``, one per series and quarter.

    An area without observations gives an all-NULL column; a series none of
    whose areas has one keeps a row with a NULL date.
    """
    routed = routed_macro(mapping, obs, width)
    picks = [F.max(c).alias(c) for c in macro_columns(routed)]
    return routed.groupBy("series_id", "n_areas", "date").agg(F.max("obs_year").alias("obs_year"), F.max("obs_quarter").alias("obs_quarter"), *picks)


def macro_for_series(
    mapping: DataFrame, obs: DataFrame, width: int | None = None, start: str | Column | None = None, end: str | Column | None = None
) -> DataFrame:
    """Daily, forward-filled macro columns of each mapped series."""
    sparse = series_macro(mapping, obs, width).drop("n_areas")
    return densify(sparse, start, end, fill=True)
