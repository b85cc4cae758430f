"""Explicit schemas and column checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, types as T

PRICE_COLUMNS = ["open", "high", "low", "close", "adj_close", "volume"]

BARS_CSV = T.StructType(
    [T.StructField("date", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in PRICE_COLUMNS]
)

AREA_MAP = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("pos", T.IntegerType()),
    ]
)


class MissingColumns(ValueError):
    """A frame lacks columns an operator needs."""

    def __init__(self, missing: list[str], present: list[str]):
        self.missing = missing
        super().__init__(f"missing columns {missing}; the frame has {present}")


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise MissingColumns(missing, df.columns)
    return df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def drop_string_columns(df: DataFrame, keep: Iterable[str] = ("series_id",)) -> DataFrame:
    kept = set(keep)
    return df.drop(*[f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in kept])


def macro_columns(df: DataFrame) -> list[str]:
    """``macro_0, macro_1, …`` in position order."""
    found = [c for c in df.columns if c.startswith("macro_") and c[6:].isdigit()]
    return sorted(found, key=lambda c: int(c[6:]))
