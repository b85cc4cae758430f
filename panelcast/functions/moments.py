"""Aggregate expressions usable in ``agg`` and, through ``over``, in windows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

MAX_DOUBLE = 1.7976931348623157e308

Over = Callable[[Column], Column]


def as_is(c: Column) -> Column:
    return c


def pair_moments(x: Column, y: Column, over: Over = as_is, complete: bool = False) -> list[Column]:
    """n, covariance and the two variances over the rows where both are present.

    ``complete`` states that neither holds NULL, which saves the masks and lets
    the variances be shared between pairs.
    """
    both = F.lit(1) if complete else F.when(x.isNotNull() & y.isNotNull(), F.lit(1))
    if not complete:
        x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return [
        over(F.count(both)).alias("n"),
        over(F.covar_pop(x, y)).alias("cov"),
        over(F.var_pop(x)).alias("vx"),
        over(F.var_pop(y)).alias("vy"),
    ]


def f_score(m: Column) -> Column:
    """Univariate regression F of a ``pair_moments`` struct.

    0 for a constant column, the largest double for an exact fit, NULL when
    the column is absent (no rows).
    """
    r2 = F.least(F.try_divide(m["cov"] * m["cov"], m["vx"] * m["vy"]), F.lit(1.0))
    f = F.coalesce(F.try_divide(r2, 1.0 - r2), F.lit(MAX_DOUBLE)) * (m["n"] - 2)
    constant = (m["vx"] == 0) | (m["vy"] == 0)
    return F.when(m["n"] > 0, F.when(constant, 0.0).otherwise(F.least(f, F.lit(MAX_DOUBLE))))


def mse(actual: Column, predicted: Column, over: Over = as_is) -> Column:
    error = actual - predicted
    return over(F.avg(error * error))


def r_squared(actual: Column, predicted: Column, over: Over = as_is) -> Column:
    """1 - SSE/SST; for a constant actual 1 when the fit is exact, else 0."""
    loss = mse(actual, predicted, over)
    flat = over(F.min(actual)) == over(F.max(actual))
    return F.when(flat, F.when(loss == 0, 1.0).otherwise(0.0)).otherwise(
        1.0 - F.try_divide(loss, over(F.var_pop(actual)))
    )


# --- the same of one series' values inside a task, where many columns would be as many aggregates of a window -----


def present(x: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values, a missing one as 0, and which are there."""
    return x.fill_null(0.0).to_numpy(zero_copy_only=False), x.is_valid().to_numpy(zero_copy_only=False)


def deviations(x: np.ndarray) -> tuple[float, np.ndarray]:
    """The mean and what each value is above it; those of a constant are 0, exactly."""
    base = x[0] if np.isfinite(x[0]) else 0.0
    x = x - base
    return float(base + x.mean()), x - x.mean()


def pair_f_score(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float | None:
    """``f_score`` of two columns, as ``present`` gives them."""
    both = x[1] & y[1]
    n = int(both.sum())
    if not n:
        return None
    (_, dx), (_, dy) = deviations(x[0][both]), deviations(y[0][both])
    cov, vx, vy = (float((a * b).mean()) for a, b in ((dx, dy), (dx, dx), (dy, dy)))
    if vx == 0 or vy == 0:
        return 0.0
    r2 = cov * cov / (vx * vy) if vx * vy else None
    if r2 is not None:
        r2 = r2 if r2 < 1 else 1.0  # Spark's least takes NaN for the greatest
    return min((r2 / (1 - r2) if r2 is not None and r2 < 1 else MAX_DOUBLE) * (n - 2), MAX_DOUBLE)


def pearson_matrix(columns: list[tuple[np.ndarray, np.ndarray]]) -> list[float | None]:
    """Pearson r of every pair of columns over the rows where both are present, row by row; None where one is constant.

    Values are taken relative to the least, so constants cancel exactly and
    little precision is lost.
    """
    x, seen = (np.column_stack(c) for c in zip(*columns, strict=True))
    with np.errstate(all="ignore"):
        x = np.where(seen, x - np.fmin.reduce(np.where(seen, x, np.nan), axis=0), 0.0)
        if np.isfinite(x).all():
            held = seen.astype(float)
            n, sums, squares, products = held.T @ held, x.T @ held, (x * x).T @ held, x.T @ x
        else:  # a product with 0 would not leave such a row out
            k = range(x.shape[1])
            own = lambda value: np.array([[value(x[seen[:, i] & seen[:, j]][:, [i, j]].T) for j in k] for i in k])
            n, sums, squares, products = own(lambda v: float(v.shape[1])), own(lambda v: v[0].sum()), own(lambda v: (v[0] * v[0]).sum()), own(lambda v: (v[0] * v[1]).sum())
        mean_square = n * squares
        left = mean_square - sums * sums
        size = np.sqrt(left) * np.sqrt(left.T)
        r = (n * products - sums * sums.T) / size
        varies = ~(left <= mean_square * 1e-13)
    there = varies & varies.T & (size != 0)
    return [float(v) if t else None for v, t in zip(r.ravel(), there.ravel(), strict=True)]
