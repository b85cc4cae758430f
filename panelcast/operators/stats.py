"""Correlations, feature scores and feature selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from panelcast.functions.moments import f_score, pair_f_score, pair_moments, pearson_matrix, present
from panelcast.windows import by_date, whole


def correlation_matrix(df: DataFrame, columns: Sequence[str], complete: bool = False) -> DataFrame:
    """Pearson r of every column pair per series, long: ``series_id, a, b, r``.

    Pairs use the rows where both columns are present; a constant column gives
    NULL. ``complete`` states that no column holds NULL; nothing depends on it.

    The sums of all pairs of a series are made in one place, from columns: a
    series has at most one row per calendar day.
    """
    low = W.partitionBy("series_id")
    # what a double holds is taken relative to the least value later on; other numbers are here, while they are exact
    plain = lambda c: isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.DoubleType))
    values = [(F.col(c) if plain(c) else F.col(c) - F.min(c).over(low)).cast("double").alias(c) for c in columns]

    @F.arrow_udf("array<double>")
    def matrix(*columns: pa.Array) -> object:
        return pearson_matrix([present(c) for c in columns])

    table = df.select("series_id", *values).groupBy("series_id").agg(matrix(*columns).alias("r"))
    names, pair = F.array(*[F.lit(c) for c in columns]), F.col("_pair")
    cells = table.select("series_id", F.posexplode("r").alias("_pair", "r"))
    place = lambda c: F.get(names, c.cast("int"))
    return cells.select("series_id", place(F.floor(pair / len(columns))).alias("a"), place(pair % len(columns)).alias("b"), "r")


def selected_correlation(correlations: DataFrame, ranked: DataFrame, target: str = "target") -> DataFrame:
    """The pairs of ``correlation_matrix`` among each series' ranked features and the target."""
    kept = ranked.groupBy("series_id").agg(F.collect_set("feature").alias("_kept"))
    inside = lambda c: F.array_contains("_kept", F.col(c)) | (F.col(c) == target)
    return correlations.join(kept, "series_id").where(inside("a") & inside("b")).drop("_kept")


def feature_scores(frame: DataFrame, features: Sequence[str], target: str = "target", on: Column | None = None) -> DataFrame:
    """F score per series and feature: ``series_id, feature_pos, feature, f_score``.

    ``on`` restricts the rows that count (e.g. the training part). Features are
    listed per row right below the aggregate, which folds them map-side: one
    small aggregate instead of one that names every feature.
    """
    y = F.col(target) if on is None else F.when(on, F.col(target))
    cells = [F.struct(F.lit(i).alias("feature_pos"), F.col(c).cast("double").alias("_x")) for i, c in enumerate(features)]
    listed = frame.select("series_id", y.alias("_y"), F.inline(F.array(*cells)))
    moments = F.struct(*pair_moments(F.col("_x"), F.col("_y")))
    names = F.array(*[F.lit(c) for c in features])
    scores = (
        listed.groupBy("series_id", "feature_pos")
        .agg(moments.alias("_m"))
        .select("series_id", "feature_pos", F.get(names, F.col("feature_pos")).alias("feature"), f_score(F.col("_m")).alias("f_score"))
    )
    return scores.where(F.col("f_score").isNotNull())


def rank_features(scores: DataFrame, k: int) -> DataFrame:
    """The k best features per series; on equal scores the later column wins."""
    best = W.partitionBy("series_id").orderBy(F.col("f_score").desc(), F.col("feature_pos").desc())
    return scores.withColumn("f_rank", F.row_number().over(best)).where(F.col("f_rank") <= k)


def with_selection(frame: DataFrame, features: Sequence[str], k: int, target: str = "target", on: Column | None = None) -> DataFrame:
    """Adds ``selected``: positions of each series' k best features, in column order.

    The same scores as ``feature_scores``, taken from the columns of a whole
    series at once, so the frame is read once instead of once for the scores
    and once for the rows.
    """

    @F.arrow_udf("array<int>")
    def best(y: pa.Array, *columns: pa.Array) -> object:
        target = present(y)
        scored = [(pair_f_score(present(c), target), i) for i, c in enumerate(columns)]
        return sorted(i for _, i in sorted((s for s in scored if s[0] is not None), reverse=True)[:k])

    y = F.col(target) if on is None else F.when(on, F.col(target))
    return frame.withColumn("selected", best(y.cast("double"), *[F.col(c).cast("double") for c in features]).over(whole()))


def project_selected(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (), most: int | None = None) -> DataFrame:
    """``series_id, date, keep…, selected, features``: the values of the selected columns as an array.

    ``most`` states how many are selected at most, which spares the lambdas.
    """
    values = F.array(*[F.col(c).cast("double") for c in features])
    if most is not None:
        slots = F.array(*[F.get(values, F.get("selected", F.lit(j))) for j in range(most)])
        return df.select("series_id", "date", *keep, "selected", F.slice(slots, F.lit(1), F.size("selected")).alias("features"))
    # The array is made once for the row: inside the inner lambda it would be made for each selected column.
    picked = F.get(F.transform(F.array(values), lambda row: F.transform("selected", lambda i: F.get(row, i))), F.lit(0))
    return df.select("series_id", "date", *keep, "selected", picked.alias("features"))


def selected_long(projected: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per series, day and selected feature."""
    names = F.array(*[F.lit(c) for c in features])
    cells = projected.select("series_id", "date", F.inline(F.arrays_zip("selected", "features")).alias("pos", "value"))
    return cells.select("series_id", "date", F.get(names, F.col("pos")).alias("feature"), "value")


def numbered(df: DataFrame, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Adds 0-based position ``t``, row count ``n`` and the ``extra`` windows of the same pass."""
    t, n = F.row_number().over(by_date()) - 1, F.count(F.lit(1)).over(whole()).cast("int")
    return df.withColumns({"t": t, "n": n} | dict(extra or {}))
