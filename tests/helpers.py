"""Small frames written as literals."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

DAY0 = date(2020, 1, 1)


def days(values, series: str = "s", start: date = DAY0):
    return [(series, start + timedelta(days=i), v) for i, v in enumerate(values)]


def closes(spark: SparkSession, *groups) -> DataFrame:
    rows = [row for g in groups for row in g]
    return spark.createDataFrame(rows, "series_id string, date date, close double")


def column(df: DataFrame, name: str, series: str | None = None) -> list:
    if series is not None:
        df = df.where(df.series_id == series)
    return [r[name] for r in df.orderBy("series_id", "date").collect()]
