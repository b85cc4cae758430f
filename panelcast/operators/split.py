"""Positional train/validation split and sliding sequences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from panelcast.operators.stats import numbered
from panelcast.windows import by_date


def is_train_row(horizon: int) -> Column:
    return F.col("t") < F.col("n") - horizon


def is_train_target(horizon: int, length: int) -> Column:
    return (F.col("t") >= length) & is_train_row(horizon)


def is_val_target(horizon: int) -> Column:
    return F.col("t") >= F.col("n") - horizon


def train_val_split(frame: DataFrame, horizon: int, length: int) -> DataFrame:
    """Adds t, n, train_size and the split flags of each row.

    train_size = n - horizon - length. Rows [0, n-horizon) train, rows
    [n-horizon-length, n) validate (the overlap is context); targets start
    ``length`` rows into either part. Series without a training row drop out.
    """
    df = numbered(frame).withColumn("train_size", F.col("n") - horizon - length).where(F.col("train_size") > 0)
    return df.withColumns(
        {
            "is_train": is_train_row(horizon),
            "is_val": F.col("t") >= F.col("train_size"),
            "is_train_target": is_train_target(horizon, length),
            "is_val_target": is_val_target(horizon),
        }
    )


def sequences(df: DataFrame, features: str = "features", length: int = 1) -> DataFrame:
    """Adds ``sequence``: the feature arrays of the ``length`` rows before each row.

    Rows without a full context drop out, leaving n - length per series. Each
    place of a sequence is a shift of the rows, which costs the same for any
    length; a list over a sliding frame is made anew from all its rows.
    """
    places = [f"_place_{k}" for k in range(length, 0, -1)]
    held = df.withColumns({f"_place_{k}": F.lag(features, k).over(by_date()) for k in range(1, length + 1)})
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in places])
    return held.where(whole).withColumn("sequence", F.array(*places)).drop(*places)
