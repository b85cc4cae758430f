"""Normalising raw bar tables."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, functions as F

from panelcast.functions.dates import lenient_timestamp

_PRICE_PREFIXES = ("Open", "High", "Low", "Close", "Adj Close", "Volume")
_CALENDAR = ("date", "day_name", "year", "month", "series_id")


def _standard_name(column: str) -> str:
    if column.startswith(_PRICE_PREFIXES):
        column = column.split("_")[0]
        return column.lower().replace(" ", "_")
    return column


def normalize_bars(raw: DataFrame, add_day_name: bool = False, regex: bool = False) -> DataFrame:
    """Raw download -> ``series_id, date, year, month, [day_name], prices``.

    The first column is the date whatever its name. Rows without a readable
    date, or whose date text holds the series code (stray header lines), are
    dropped; price columns lose any ``_suffix``; columns outside the required
    set are dropped and required ones that are absent are left out. Two columns
    that come to one name raise. A row without a series code is kept, as no
    code can be in its date. ``regex`` reads the code as a pattern instead of
    literal text.
    """
    first = raw.columns[0]
    df = raw.withColumnRenamed(first, "date").where(F.col("date").isNotNull())
    text = F.col("date").cast("string")
    code = F.col("series_id")
    stray = F.expr("rlike(cast(date as string), series_id)") if regex else text.contains(code)
    df = df.where(~F.coalesce(stray, F.lit(False)))
    df = df.withColumn("date", F.to_date(lenient_timestamp(text))).where(F.col("date").isNotNull())
    df = df.withColumns({"year": F.year("date"), "month": F.month("date")})
    if add_day_name:
        df = df.withColumn("day_name", F.date_format("date", "EEEE"))
    df = df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    names = Counter(_standard_name(c) for c in df.columns if c not in _CALENDAR)
    twice = [c for c in df.columns if c not in _CALENDAR and names[_standard_name(c)] > 1]
    if twice:
        raise ValueError(f"columns that come to one name: {twice}")
    df = df.withColumnsRenamed({c: _standard_name(c) for c in df.columns if c not in _CALENDAR})
    wanted = ["series_id", "date", "year", "month"] + (["day_name"] if add_day_name else [])
    wanted += ["open", "high", "low", "close", "adj_close", "volume"]
    return df.select([c for c in wanted if c in df.columns])
