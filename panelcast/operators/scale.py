"""Per-series scalers, fitted on chosen rows and applied to all."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.functions.moments import deviations
from panelcast.operators.quantiles import exact_quantiles
from panelcast.session import materialize
from panelcast.windows import whole

Over = Callable[[Column], Column]


def _non_zero(scale: Column) -> Column:
    return F.when(scale == 0, 1.0).otherwise(scale)


def _standard(x: Column, over: Over) -> tuple[Column, Column]:
    return over(F.avg(x)), _non_zero(over(F.stddev_pop(x)))


def _normalize(x: Column, over: Over) -> tuple[Column, Column]:
    low = over(F.min(x))
    return low, _non_zero(over(F.max(x)) - low)


def _robust(x: Column, over: Over) -> tuple[Column, Column]:
    q = over(F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
    return q[1], _non_zero(q[2] - q[0])


SCALERS = {"standard": _standard, "normalize": _normalize, "robust": _robust}


def scaler(method: str):
    """Unknown names mean the standard scaler."""
    return SCALERS.get(method, _standard)


def is_standard(method: str) -> bool:
    return scaler(method) is _standard


def scaler_state(columns: Sequence[str], method: str, fit_on: Column | None = None) -> dict[str, Column]:
    """``{c}_center`` and ``{c}_scale`` of each column as windows over the series."""
    state: dict[str, Column] = {}
    for c in columns:
        x = F.col(c).cast("double")
        center, scale = scaler(method)(x if fit_on is None else F.when(fit_on, x), lambda a: a.over(whole()))
        state |= {f"{c}_center": center, f"{c}_scale": scale}
    return state


def with_state(df: DataFrame, columns: Sequence[str], method: str, fit_on: Column | None = None) -> DataFrame:
    """Adds ``{c}_center`` and ``{c}_scale`` of each column, those of ``scaler_state``.

    The standard scaler's are taken from the columns of a whole series at
    once, in the same pass for all of them.
    """
    if not is_standard(method):
        return df.withColumns(scaler_state(columns, method, fit_on))

    @F.arrow_udf("array<double>")
    def fitted(*columns: pa.Array) -> object:
        state: list[float | None] = []
        for x in columns:
            x = x.drop_null().to_numpy(zero_copy_only=False)
            if not len(x):
                state += [None, None]
                continue
            with np.errstate(all="ignore"):
                center, apart = deviations(x)
                size = float(np.sqrt((apart * apart).mean()))
            state += [center, size if size != 0 else 1.0]
        return state

    values = [F.col(c).cast("double") if fit_on is None else F.when(fit_on, F.col(c).cast("double")) for c in columns]
    held = df.withColumn("_fitted", fitted(*values).over(whole()))
    part = lambda k: F.get("_fitted", F.lit(k))
    return held.withColumns({f"{c}_{name}": part(2 * i + k) for i, c in enumerate(columns) for k, name in enumerate(("center", "scale"))}).drop("_fitted")


def apply_scaler(df: DataFrame, columns: Sequence[str], keep_state: Sequence[str] = ()) -> DataFrame:
    """Replaces each column by (x - centre) / scale and drops the state not kept."""
    scaled = df.withColumns({c: (F.col(c).cast("double") - F.col(f"{c}_center")) / F.col(f"{c}_scale") for c in columns})
    return scaled.drop(*[f"{c}_{s}" for c in columns if c not in keep_state for s in ("center", "scale")])


def grouped_state(df: DataFrame, columns: Sequence[str], method: str, fit_on: Column | None = None) -> DataFrame:
    """One row per series with each column's ``{c}_center`` and ``{c}_scale``.

    The robust scaler's quartiles come from ``exact_quantiles``, whose memory
    does not grow with a series.
    """
    if scaler(method) is _robust:
        quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], fit_on)
        own = lambda c: F.max(F.when(F.col("column") == c, F.col("quantiles")))
        held = quartiles.groupBy("series_id").agg(*[own(c).alias(f"{c}_q") for c in columns])
        part = lambda c, k: F.get(F.col(f"{c}_q"), F.lit(k))
        return held.select("series_id", *[x for c in columns for x in (part(c, 1).alias(f"{c}_center"), _non_zero(part(c, 2) - part(c, 0)).alias(f"{c}_scale"))])
    state = []
    for c in columns:
        x = F.col(c).cast("double")
        center, scale = scaler(method)(x if fit_on is None else F.when(fit_on, x), lambda a: a)
        state += [center.alias(f"{c}_center"), scale.alias(f"{c}_scale")]
    return df.groupBy("series_id").agg(*state)


def scale_columns(
    df: DataFrame, columns: Sequence[str], method: str, fit_on: Column | None = None, keep_state: Sequence[str] = (), settle: bool = False
) -> DataFrame:
    """Fits and applies a scaler per series and column.

    The state is taken over the series window next to the rows, which needs no
    join back. ``settle`` writes the rows first, fits in one hash aggregation
    and joins the state back, which pays with many columns. ``keep_state``
    names columns whose ``{c}_center`` and ``{c}_scale`` stay for the inverse.
    """
    if settle:
        rows = materialize(df)
        return apply_scaler(rows.join(grouped_state(rows, columns, method, fit_on), "series_id"), columns, keep_state)
    return apply_scaler(with_state(df, columns, method, fit_on), columns, keep_state)


def inverse_scale(value: Column, center: Column, scale: Column) -> Column:
    return value * scale + center
