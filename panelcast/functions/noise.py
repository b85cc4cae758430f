"""Deterministic Gaussian draws keyed by row, not by partition."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_TWO_32 = float(2**32)


# Which half of the 128-bit digest feeds which named draw.
_HALF = {"random": 1, "ou": 17}


def day_number(date: Column) -> Column:
    """Days since 1970, a cheaper key text than the formatted date."""
    return F.unix_date(date)


def gaussian(seed: int, name: str, *keys: Column) -> Column:
    """One N(0, 1) draw per key tuple: Box-Muller over an md5 of the key text.

    The same row gets the same draw on any cluster, in any partitioning and
    after any task retry. The named draws use different halves of one digest,
    which is computed once where both are taken.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))
    start = _HALF[name]
    high = F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
    low = F.conv(F.substring(digest, start + 8, 8), 16, 10).cast("long")
    radius = F.sqrt(F.lit(-2.0) * F.log((high + 1.0) / _TWO_32))
    return radius * F.cos(F.lit(2 * 3.141592653589793) * low / _TWO_32)
