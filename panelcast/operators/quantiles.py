"""Exact quantiles of every series in bounded memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Accuracy of the sketches; a quantile's bracket holds about 16 in so many of a series' values.
ACCURACY = 1000


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], fit_on: Column | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """``series_id, column, n, quantiles ARRAY``, linear between neighbours as ``percentile`` gives them.

    ``percentile`` keeps all of a series' values in one buffer. Here a
    mergeable sketch first brackets each quantile between two values, wide
    enough for the sketch's error, and counts; a second pass counts what lies
    below the bracket and adds up the equal values inside it, which partial
    aggregates do; the exact ranks are then found among these. A series of few
    values is its own bracket. NULL and NaN do not count; a column without
    values has NULL quantiles.
    """
    margin = 8 / accuracy
    wanted = [min(1.0, max(0.0, p + m)) for p in probs for m in (-margin, margin)]
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    taken = {c: value(c) if fit_on is None else F.when(fit_on, value(c)) for c in columns}
    rows = df.select("series_id", *[v.alias(c) for c, v in taken.items()])
    sketch = [
        F.struct(F.count(c).alias("n"), F.min(c).alias("least"), F.max(c).alias("most"), F.percentile_approx(c, F.array(*map(F.lit, wanted)), F.lit(accuracy)).alias("at")).alias(f"_s{i}")
        for i, c in enumerate(columns)
    ]
    brackets = rows.groupBy("series_id").agg(*sketch)

    def bracket(s: Column) -> Column:
        few = s["n"] <= accuracy // 4
        ends = lambda k: F.get(s["at"], F.lit(k))
        low = [F.lit(True) if p - margin <= 0 else few for p in probs]
        high = [F.lit(True) if p + margin >= 1 else few for p in probs]
        pairs = [F.struct(F.when(low[k], s["least"]).otherwise(ends(2 * k)).alias("low"), F.when(high[k], s["most"]).otherwise(ends(2 * k + 1)).alias("high")) for k in range(len(probs))]
        return F.struct(s["n"].alias("n"), F.array(*pairs).alias("pairs"))

    brackets = brackets.select("series_id", *[bracket(F.col(f"_s{i}")).alias(f"_s{i}") for i in range(len(columns))])
    joined = rows.join(brackets, "series_id")
    # per column and quantile, what is below its bracket is a count, what is inside a row with its value
    cells = F.array(*[
        F.struct(F.lit(i).alias("column"), F.lit(k).alias("k"), F.col(c).alias("x"), F.get(F.col(f"_s{i}.pairs"), F.lit(k)).alias("pair"))
        for i, c in enumerate(columns) for k in range(len(probs))
    ])
    near = F.filter(cells, lambda e: e["x"] <= e["pair"]["high"])
    listed = joined.select("series_id", F.inline(F.transform(near, lambda e: F.struct(e["column"].alias("column"), e["k"].alias("k"), F.when(e["x"] >= e["pair"]["low"], e["x"]).alias("x")))))
    counted = listed.groupBy("series_id", "column", "k", "x").agg(F.count(F.lit(1)).alias("times"))
    upto = F.sum("times").over(W.partitionBy("series_id", "column", "k").orderBy(F.col("x").asc_nulls_first()))
    ranked = counted.withColumn("upto", upto)  # values with 0-based ranks below upto
    sizes = brackets.select("series_id", F.inline(F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"_s{i}.n").alias("n")) for i in range(len(columns))])))
    ranked = ranked.where("x IS NOT NULL").join(sizes, ["series_id", "column"])
    rank = (F.col("n") - 1) * F.get(F.array(*map(F.lit, probs)), F.col("k"))
    has = lambda r: F.min(F.when(F.col("upto") > r, F.col("x")))
    found = ranked.withColumn("rank", rank).groupBy("series_id", "column", "k", "rank").agg(has(F.floor("rank")).alias("a"), has(F.ceil("rank")).alias("b"))
    exact = F.col("a") + (F.col("b") - F.col("a")) * (F.col("rank") - F.floor("rank"))
    gathered = found.groupBy("series_id", "column").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", exact.alias("q")))), lambda e: e["q"]).alias("quantiles"))
    names = F.array(*map(F.lit, columns))
    return sizes.join(gathered, ["series_id", "column"], "left").select("series_id", F.get(names, F.col("column")).alias("column"), "n", "quantiles")
