"""Calendar densify, forward fill, as-of join, wide form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from panelcast.session import stored
from panelcast.windows import running


def _day(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def calendar_bounds(rows: DataFrame, start: str | Column | None, end: str | Column | None) -> tuple[Column, Column]:
    """The given days, or else the first and last date of the rows."""
    lo = rows.agg(F.min("date")).scalar() if start is None else _day(start)
    hi = rows.agg(F.max("date")).scalar() if end is None else _day(end)
    return lo, hi


def densify(
    rows: DataFrame,
    start: str | Column | None = None,
    end: str | Column | None = None,
    *,
    keys: Sequence[str] = ("series_id",),
    layer: str | None = None,
    carry: Sequence[str] = (),
    fill: bool = False,
) -> DataFrame:
    """One row per key and calendar day from start to end, both included.

    The calendar runs from the first to the last date of the rows unless the
    caller gives other days (text, or a column such as a subquery).

    Equal to (keys x calendar) LEFT JOIN rows, followed by a per-column forward
    fill when ``fill`` is set: rows outside the calendar give no value, days
    before the first row stay NULL. It never builds the calendar product:
    only the observed rows are shuffled and sorted, and each then emits the
    days up to the next one. A row with a NULL date, or one outside the
    calendar, keeps its key in the result without giving it a value.

    Two rows with equal key and date raise an error naming them. With
    ``layer`` (a column) several sources may be stacked: rows are unique per
    layer, and the days of a date carry the columns of all layers (only
    meaningful together with ``fill``). ``carry`` names columns that are
    constant per key and go to every day.
    """
    lo, hi = calendar_bounds(rows, start, end)
    values = [c for c in rows.columns if c not in (*keys, "date", layer, *carry)]
    tie = [F.col(layer)] if layer else []
    ordered = W.partitionBy(*keys).orderBy(F.col("date").asc_nulls_last(), *tie)
    so_far = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)

    steps = {
        "_nth": F.row_number().over(ordered),
        "_next": F.lead("date").over(ordered),
        "_twin": F.lag(F.struct("date", *tie)).over(ordered) == F.struct("date", *tie),
    }
    if fill:
        steps |= {c: F.last(c, ignorenulls=True).over(so_far) for c in values}
    # the bounds become columns: a subquery may stand in a projection, not in the generator below
    inside = rows.withColumns({"_lo": lo, "_hi": hi})
    known = F.col("date").between(F.col("_lo"), F.col("_hi"))
    inside = inside.withColumns({c: F.when(known, F.col(c)) for c in ("date", *values)})
    spans = inside.withColumns(steps)

    opening = F.when(F.col("_nth") == 1, F.col("_lo")).otherwise(F.col("date"))
    closing = F.coalesce(F.date_sub("_next", 1), F.col("_hi"))
    duplicate = F.concat_ws(" ", F.lit("duplicate row for"), *[F.col(k).cast("string") for k in keys], F.col("date").cast("string"))
    days = (
        F.when(F.col("_twin") & F.col("date").isNotNull(), F.raise_error(duplicate))
        .when(F.col("date").isNull() & (F.col("_nth") > 1), F.lit(None))
        .when(closing >= opening, F.sequence(opening, closing))
    )
    seen = F.col("_day") >= F.col("date") if fill else F.col("_day") == F.col("date")
    return spans.withColumn("_day", F.explode(days)).select(
        *keys, F.col("_day").alias("date"), *[F.when(seen, F.col(c)).alias(c) for c in values], *carry
    )


def forward_fill(panel: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Last non-NULL value so far, per column; a leading gap stays NULL."""
    columns = columns or [c for c in panel.columns if c not in ("series_id", "date")]
    return panel.withColumns({c: F.last(c, ignorenulls=True).over(running()) for c in columns})


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    values: Sequence[str],
    bucket_days: int = 64,
    lag_days: int = 0,
    settle: bool = False,
    share_rows: int | None = None,
) -> DataFrame:
    """Each left row gets the last right row with ``right.date <= left.date``.

    Right rows become validity ranges, the last of a key open-ended, and are
    listed under every calendar bucket in which the left side has days; left
    rows carry one bucket, so the join is an equi-join on (key, bucket) plus a
    range test. The left side is neither sorted by time nor grouped, and a hot
    key is spread over its buckets. Two right rows of one key and date raise,
    so a key has no more right rows than days. ``lag_days`` shifts the right
    side (publication delay). ``settle`` writes the ranges to the shared folder
    first: Spark then knows their size when it chooses between broadcast and
    shuffle, and a small right side spares the left one its shuffle.

    With ``share_rows`` the left rows of each (key, bucket) are counted first;
    where there are more, they are dealt to shares of about so many, and the
    ranges of that pair are copied to each share. So a task gets about
    ``share_rows`` left rows of a pair, whichever key has most of them.
    """
    bucket = lambda d: F.floor(F.datediff(d, _day("1970-01-01")) / bucket_days)
    order = W.partitionBy(*by).orderBy("_from")
    twice = F.concat_ws(" ", F.lit("two right rows for"), *[F.col(k).cast("string") for k in by], F.col("_from").cast("string"))
    following = F.lead("_from").over(order)
    ranges = right.select(*by, F.date_add("date", lag_days).alias("_from"), *values).where(F.col("_from").isNotNull())
    ranges = ranges.withColumn("_to", F.when(following == F.col("_from"), F.raise_error(twice).cast("date")).otherwise(following))
    lo, hi = (left.agg(f("date")).scalar() for f in (F.min, F.max))
    ranges = ranges.withColumns({"_lo": lo, "_hi": hi})
    ranges = ranges.where((F.coalesce(F.col("_to") > F.col("_lo"), F.lit(True))) & (F.col("_from") <= F.col("_hi")))
    first = bucket(F.greatest(F.col("_from"), F.col("_lo")))
    last = bucket(F.least(F.coalesce(F.date_sub("_to", 1), F.col("_hi")), F.col("_hi")))
    ranges = ranges.withColumn("_bucket", F.explode(F.sequence(first, last))).drop("_lo", "_hi")
    if settle:
        ranges = stored(ranges, "ranges")
    a = left.withColumn("_bucket", bucket(F.col("date")))
    if share_rows:
        a, ranges = _in_shares(a, ranges, [*by, "_bucket"], share_rows)
    inside = (F.col("a.date") >= F.col("b._from")) & (F.col("b._to").isNull() | (F.col("a.date") < F.col("b._to")))
    a, b = a.alias("a"), ranges.alias("b")
    same = F.col("a._bucket") == F.col("b._bucket")
    if share_rows:
        same = same & (F.col("a._share") == F.col("b._share"))
    for k in by:
        same = same & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return a.join(b, same & inside, "left").select(*[F.col(f"a.{c}") for c in left.columns], *[F.col(f"b.{v}") for v in values])


def _in_shares(left: DataFrame, right: DataFrame, keys: Sequence[str], share_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_share``: left rows of heavy keys dealt by hash, the right rows of these copied to every share.

    Heavy keys are few: each stands for more than ``share_rows`` left rows.
    """
    heavy = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > share_rows)
    heavy = stored(heavy.select(*keys, F.ceil(F.col("_n") / share_rows).cast("int").alias("_shares")), "heavy")
    shares = F.coalesce("_shares", F.lit(1))
    dealt = left.join(heavy, list(keys), "left").withColumn("_share", F.pmod(F.xxhash64(*left.columns), shares).cast("int"))
    copied = right.join(heavy, list(keys), "left").withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1)))
    return dealt.drop("_shares"), copied.drop("_shares")


def to_wide(panel: DataFrame, series: Sequence[str] | None = None, value: str = "close") -> DataFrame:
    """One row per date, one ``{value}_{series}`` column per series, or per listed one.

    Without a list the series are those of the rows; more than Spark's limit
    for pivots (``spark.sql.pivotMaxValues``) raise.
    """
    wide = panel.groupBy("date").pivot("series_id", None if series is None else list(series)).agg(F.first(value, ignorenulls=True))
    return wide.withColumnsRenamed({s: f"{value}_{s}" for s in wide.columns if s != "date"})
