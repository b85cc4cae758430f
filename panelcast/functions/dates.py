"""Calendar and period functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def calendar_columns(df: DataFrame, date: str = "date") -> DataFrame:
    """year, month, quarter and the English day name."""
    d = F.col(date)
    return df.withColumns(
        {
            "year": F.year(d),
            "month": F.month(d),
            "quarter": F.quarter(d),
            "day_name": F.date_format(d, "EEEE"),
        }
    )


def seasonal_columns(df: DataFrame, date: str = "date") -> DataFrame:
    """month, Monday-based weekday number, quarter and the cyclic month."""
    d = F.col(date)
    angle = F.month(d) * F.lit(2 * 3.141592653589793 / 12)
    return df.withColumns(
        {
            "month": F.month(d),
            "day_of_week": F.weekday(d),
            "quarter": F.quarter(d),
            "sin_month": F.sin(angle),
            "cos_month": F.cos(angle),
        }
    )


def years_before(date: Column, n_years: int) -> Column:
    """n calendar years earlier; 29 February clamps to the 28th."""
    return F.add_months(date, -12 * n_years)


def quarter_start(period: Column) -> Column:
    """First day of a ``YYYY-Qn`` period, NULL when the text is not one."""
    year = F.regexp_extract(period, r"^(\d{1,4})-Q([1-4])$", 1)
    quarter = F.regexp_extract(period, r"^(\d{1,4})-Q([1-4])$", 2)
    return F.make_date(
        year.try_cast("int"),
        quarter.try_cast("int") * 3 - 2,
        F.lit(1),
    )


def lenient_timestamp(text: Column) -> Column:
    """Parsed timestamp, NULL instead of an error."""
    return text.try_cast("timestamp")


def lenient_double(text: Column) -> Column:
    """Parsed number; unreadable text and NaN both become NULL."""
    number = text.try_cast("double")
    return F.when(~F.isnan(number), number)
