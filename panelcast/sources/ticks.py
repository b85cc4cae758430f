"""Bars from raw ticks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from panelcast.schema import require_columns

_UNIT = {"m": "minutes", "h": "hours"}
_PACKABLE = {"byte", "short", "integer", "long", "date", "timestamp", "timestamp_ntz"}


def _bar_start(interval: str) -> Column:
    """The start of a tick's bar. Weeks and runs of days count from a Monday, months from January."""
    found = re.fullmatch(r"(\d+)(mo|wk|m|h|d)", interval)
    if not found:
        raise ValueError(f"unknown interval {interval!r}")
    count, unit = int(found[1]), found[2]
    if unit == "mo":
        months = F.year("ts") * 12 + F.month("ts") - 1
        first = months - months % count
        return F.make_date(F.floor(first / 12).cast("int"), (first % 12 + 1).cast("int"), F.lit(1)).alias("date")
    if interval == "1d":
        return F.to_date("ts").alias("date")
    days = {"d": 1, "wk": 7}.get(unit)
    if days:  # 1969-12-29 was a Monday
        since = F.datediff(F.to_date("ts"), F.lit("1969-12-29").cast("date"))
        return F.date_add(F.lit("1969-12-29").cast("date"), since - F.pmod(since, F.lit(count * days))).alias("date")
    return F.window("ts", f"{count} {_UNIT[unit]}")["start"].alias("date")


def _order_key(ticks: DataFrame, names: list[str]) -> Column:
    """One fixed-width number that sorts like the columns, so the bars stay in hash aggregation.

    Two columns (whole numbers or times) are packed into 38 digits; a first one
    beyond 4.9e18 raises.
    """
    whole = []
    for name in names:
        kind = ticks.schema[name].dataType.typeName()
        time = {"timestamp": F.unix_micros(name), "timestamp_ntz": F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(name)), "date": F.unix_date(name)}
        whole.append((time[kind] if kind in time else F.col(name)).cast("decimal(20,0)"))
    packed = (whole[0] * F.lit(str(2 * 10**19)).cast("decimal(20,0)")).cast("decimal(38,0)") + whole[1].cast("decimal(38,0)")
    packed = packed.cast("decimal(38,0)")
    return F.when(packed.isNull() & whole[0].isNotNull() & whole[1].isNotNull(), F.raise_error(F.lit(f"{names} do not fit one key"))).otherwise(packed)


def resample_bars(ticks: DataFrame, order_by: list[str], interval: str = "1d") -> DataFrame:
    """OHLCV bars from ``series_id, ts, price, volume`` plus ordering columns.

    ``order_by`` says which tick of a bar is first and last. It must make the
    order unique up to equal prices. One column, or two of whole numbers or
    times, keep the aggregate in hash aggregation; others are compared as one
    struct, which sorts. Either way each map task sends at most one row per
    bar, so a series holding a third of all ticks costs no more than any other.
    """
    require_columns(ticks, ["series_id", "ts", "price", "volume", *order_by])
    price = F.col("price")
    plain = all(ticks.schema[c].dataType.typeName() in _PACKABLE for c in order_by)
    if len(order_by) == 1 or (len(order_by) == 2 and plain):
        key = F.col(order_by[0]) if len(order_by) == 1 else _order_key(ticks, order_by)
        first, last = F.min_by(price, key), F.max_by(price, key)
    else:
        key = F.struct(*order_by, price)
        first, last = F.min(key)["price"], F.max(key)["price"]
    return ticks.groupBy("series_id", _bar_start(interval)).agg(
        first.alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        last.alias("close"),
        F.sum("volume").cast("double").alias("volume"),
    )


def day_bounds(ticks: DataFrame) -> tuple[Column, Column]:
    """The first and last day of the ticks, as subqueries that run with the plan that uses them."""
    return tuple(ticks.agg(F.to_date(f("ts"))).scalar() for f in (F.min, F.max))
