"""Windows over series that are too long for one task.

``windows`` gives a whole series to one task, which a daily calendar bounds.
Here the rows of a series lie in blocks of consecutive rows, each a task's
work. What a running window needs from the rows before a block is a summary of
the earlier blocks, found by a window over one row per block; what a bounded
frame needs is a few rows of its neighbours, which are copied to it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from panelcast.session import stored

BLOCK_ROWS = 1 << 18
_HELPERS = ["_block", "_t"]


def _inside():
    return W.partitionBy("series_id", "_block").orderBy("_t")


def _earlier():
    return W.partitionBy("series_id").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)


def in_blocks(rows: DataFrame, order: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows, written, with ``_block`` and ``_t``: their place in the series (from 0) by ``order``.

    ``order`` must tell the rows of a series apart. Rows are dealt by ranges
    of (series, order), about ``block_rows`` a range, so one series is spread
    like many.
    """
    taken = {*_HELPERS, "_place", "_first"} & set(rows.columns)
    if taken:
        raise ValueError(f"the rows already have {sorted(taken)}")
    ranges = max(1, -(-rows.count() // block_rows))
    dealt = rows.repartitionByRange(ranges, "series_id", *order).withColumn("_block", F.spark_partition_id())
    dealt = stored(dealt, "blocks")
    local = dealt.withColumn("_place", F.row_number().over(W.partitionBy("series_id", "_block").orderBy(*order)) - 1)
    sizes = dealt.groupBy("series_id", "_block").agg(F.count(F.lit(1)).alias("_first"))
    starts = sizes.select("series_id", "_block", F.coalesce(F.sum("_first").over(_earlier()), F.lit(0)).alias("_first"))
    return stored(local.join(starts, ["series_id", "_block"]).withColumn("_t", F.col("_first") + F.col("_place")).drop("_first", "_place"), "placed")


def carried_fill(blocks: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Adds, for each new name, the last value so far of a column that is not NULL."""
    last = blocks.groupBy("series_id", "_block").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_t"))).alias(f"_{n}") for n, c in columns.items()])
    carry = last.select("series_id", "_block", *[F.last(f"_{n}", ignorenulls=True).over(_earlier()).alias(f"_{n}") for n in columns])
    so_far = _inside().rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = blocks.join(carry, ["series_id", "_block"])
    filled = {n: F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.col(f"_{n}")) for n, c in columns.items()}
    return joined.withColumns(filled).drop(*[f"_{n}" for n in columns])


def carried_sum(blocks: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Adds running sums of the given values (NULL adds nothing; NULL before the first value)."""
    totals = blocks.groupBy("series_id", "_block").agg(*[F.sum(c).alias(f"_{n}") for n, c in columns.items()])
    carry = totals.select("series_id", "_block", *[F.sum(f"_{n}").over(_earlier()).alias(f"_{n}") for n in columns])
    so_far = _inside().rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = blocks.join(carry, ["series_id", "_block"])

    def total(name: str, value: Column) -> Column:
        own, before = F.sum(value).over(so_far), F.col(f"_{name}")
        return F.coalesce(own + before, own, before)

    return joined.withColumns({n: total(n, c) for n, c in columns.items()}).drop(*[f"_{n}" for n in columns])


def framed(blocks: DataFrame, before: int, after: int, columns: Mapping[str, Callable[[WindowSpec], Column]], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds window columns whose frames reach ``before`` rows back and ``after`` rows ahead.

    Each column is a function of the ordered window (add a frame with
    ``rowsBetween``, or use ``lag`` and ``lead``). Rows near the edge of a
    block are copied to the neighbour for which they are context, and the
    copies dropped again; the blocks here are ``block_rows`` places long, and
    at least as long as the reach.
    """
    size = max(block_rows, before, after, 1)
    home = F.floor(F.col("_t") / size)
    place = F.col("_t") % size
    reach = F.array(F.when(place < after, home - 1), home, F.when(place >= size - before, home + 1))
    spread = blocks.withColumn("_home", home).withColumn("_part", F.explode(F.filter(reach, lambda b: b >= 0)))
    window = W.partitionBy("series_id", "_part").orderBy("_t")
    found = spread.withColumns({name: use(window) for name, use in columns.items()})
    return found.where(F.col("_part") == F.col("_home")).drop("_home", "_part")


def forward_fill(blocks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``panel.forward_fill`` of rows in blocks."""
    filled = carried_fill(blocks, {f"{c}_filled": c for c in columns})
    return filled.drop(*columns).withColumnsRenamed({f"{c}_filled": c for c in columns})


def moving_average(blocks: DataFrame, value: str, n: int, name: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Trailing mean of n rows; NULL unless all n hold a value."""

    def mean(w: WindowSpec) -> Column:
        frame = w.rowsBetween(-(n - 1), 0)
        return F.when(F.count(value).over(frame) == n, F.avg(value).over(frame))

    return framed(blocks, n - 1, 0, {name: mean}, block_rows)


def centred_average(blocks: DataFrame, value: str, period: int, name: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``decompose``'s trend: ``period`` rows about each row, an even period with half weight on the two ends.

    From running sums, so the work per row does not depend on the period; a
    row whose frame is not full of values has NULL.
    """
    half = period // 2
    sums = carried_sum(blocks, {"_sum": F.coalesce(F.col(value), F.lit(0)), "_count": F.col(value).isNotNull().cast("long")})

    def mean(w: WindowSpec) -> Column:
        part = lambda c: F.lead(c, half).over(w) - F.coalesce(F.lag(c, half + 1).over(w), F.when(F.col("_t") == half, F.lit(0)))
        total = part("_sum")
        if period % 2 == 0:
            total = total - (F.lag(value, half).over(w) + F.lead(value, half).over(w)) / 2
        return F.when(part("_count") == 2 * half + 1, total / period)

    return framed(sums, half + 1, half, {name: mean}, block_rows).drop("_sum", "_count")
