"""Window specs of a panel.

A panel has at most one row per (series, day) -- ``densify`` raises when it
does not -- so a series is never longer than its calendar and one window
group stays small however skewed the raw ticks were. Every spec below sorts
by (series_id, date), so consecutive operators share one shuffle and one sort.
"""

from __future__ import annotations

from pyspark.sql import Window as W


def by_date():
    return W.partitionBy("series_id").orderBy("date")


def running():
    """The first row up to the current one."""
    return by_date().rowsBetween(W.unboundedPreceding, W.currentRow)


def whole():
    """All rows of the series, in an order that keeps the shared sort."""
    return by_date().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)


def trailing(n: int):
    """The current row and the n-1 before it."""
    return by_date().rowsBetween(-(n - 1), W.currentRow)


def before(n: int):
    """The n rows before the current one."""
    return by_date().rowsBetween(-n, -1)
