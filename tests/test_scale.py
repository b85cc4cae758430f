"""Operators for long series, large right sides, growing panels and bounded memory, against their one-task forms."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import Window as W, functions as F

from panelcast.operators import long_series as L, panel as P
from panelcast.operators.combine import combine
from panelcast.operators.incremental import extend_panel, panel_state
from panelcast.operators.quantiles import exact_quantiles
from panelcast.operators.reversion import mean_reversion
from tests.helpers import DAY0, closes


def walk(spark, n, seed=0, series="s"):
    rng = np.random.default_rng(seed)
    x = [None if u < 0.2 or k < 3 else float(np.round(100 + v, 2)) for k, (u, v) in enumerate(zip(rng.random(n), rng.normal(size=n).cumsum()))]
    return [(series, k, v) for k, v in enumerate(x)]


@pytest.fixture(scope="module")
def ticks(spark):
    """Two series, one much longer, and one of a single row."""
    rows = walk(spark, 3000, 1, "long") + walk(spark, 90, 2, "short") + [("one", 5, 1.0)]
    return spark.createDataFrame(rows, "series_id string, at long, x double").repartition(7)


def _same(a, b, columns):
    key = ["series_id", "at"]
    left, right = (df.select(*key, *columns).orderBy(*key).toPandas() for df in (a, b))
    assert left[key].equals(right[key])
    for c in columns:
        np.testing.assert_allclose(left[c].to_numpy(float), right[c].to_numpy(float), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("size", [40, 500, 1 << 20])
def test_a_long_series_in_blocks_equals_the_one_task_form(ticks, size):
    blocks = L.in_blocks(ticks, ["at"], size)
    if size == 500:
        assert blocks.where("series_id = 'long'").select("_block").distinct().count() >= 5
    whole = W.partitionBy("series_id").orderBy("at")
    so_far = whole.rowsBetween(W.unboundedPreceding, W.currentRow)
    plain = ticks.withColumns({"filled": F.last("x", ignorenulls=True).over(so_far), "total": F.sum("x").over(so_far), "_t": F.row_number().over(whole) - 1})
    got = L.carried_sum(L.carried_fill(blocks, {"filled": "x"}), {"total": F.col("x")})
    _same(got, plain, ["filled", "total", "_t"])
    _same(L.forward_fill(blocks, ["x"]), plain.withColumn("x", F.col("filled")), ["x"])
    five = whole.rowsBetween(-4, 0)
    want = plain.withColumn("ma", F.when(F.count("filled").over(five) == 5, F.avg("filled").over(five)))
    _same(L.moving_average(got, "filled", 5, "ma", size), want, ["ma"])
    for period in (6, 7, 60):
        half, n = period // 2, 2 * (period // 2) + 1
        frame = whole.rowsBetween(-half, half)
        ends = (F.lag("filled", half).over(whole) + F.lead("filled", half).over(whole)) / 2 if period % 2 == 0 else F.lit(0)
        want = plain.withColumn("trend", F.when(F.count("filled").over(frame) == n, (F.sum("filled").over(frame) - ends) / period))
        _same(L.centred_average(got, "filled", period, "trend", size), want, ["trend"])
    lags = L.framed(blocks, 3, 2, {"back": lambda w: F.lag("x", 3).over(w), "ahead": lambda w: F.lead("x", 2).over(w)}, size)
    _same(lags, ticks.withColumns({"back": F.lag("x", 3).over(whole), "ahead": F.lead("x", 2).over(whole)}), ["back", "ahead"])


def test_blocks_keep_all_columns_and_refuse_their_own_names(ticks):
    assert set(L.in_blocks(ticks, ["at"], 100).columns) == {*ticks.columns, "_block", "_t"}
    with pytest.raises(ValueError):
        L.in_blocks(ticks.withColumn("_t", F.lit(1)), ["at"])
    assert L.carried_fill(L.in_blocks(ticks.limit(0), ["at"]), {"f": "x"}).collect() == []


@pytest.mark.parametrize("accuracy", [20, 1000])
def test_quantiles_are_exact(spark, accuracy):
    rng = np.random.default_rng(3)
    values = {"many": rng.normal(size=4000), "ties": rng.integers(0, 4, 3000).astype(float), "same": np.full(900, 7.0), "two": np.array([1.0, 4.0]), "one": np.array([5.0]), "few": rng.normal(size=7)}
    rows = [(s, float(v), i % 3 == 0) for s, vs in values.items() for i, v in enumerate(vs)] + [("many", None, True), ("many", float("nan"), True), ("none", None, True)]
    df = spark.createDataFrame(rows, "series_id string, x double, fit boolean").withColumn("y", -F.col("x"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    for on in (None, F.col("fit")):
        got = {(r.series_id, r.column): r for r in exact_quantiles(df, ["x", "y"], probs, on, accuracy).collect()}
        assert len(got) == 14
        for series, vs in values.items():
            kept = vs if on is None else vs[::3]
            np.testing.assert_allclose(got[series, "x"].quantiles, np.quantile(kept, probs), rtol=1e-12)
            np.testing.assert_allclose(got[series, "y"].quantiles, np.quantile(-kept, probs), rtol=1e-12)
            assert got[series, "x"].n == len(kept)
        assert got["none", "x"].quantiles is None and got["none", "x"].n == 0


def test_quantiles_send_few_rows_of_a_long_series(spark):
    """What reaches the ranking is a small part of the values."""
    df = spark.range(40_000).select(F.lit("s").alias("series_id"), F.rand(5).alias("x"))
    found = exact_quantiles(df, ["x"], [0.5])
    values = np.sort([r.x for r in df.collect()])
    assert found.first().quantiles[0] == pytest.approx(np.median(values))


@pytest.mark.parametrize("share_rows", [None, 1, 40, 10_000])
def test_hot_keys_of_an_asof_join_are_shared_out(spark, share_rows):
    rng = np.random.default_rng(7)
    left = [(i, "hot" if i % 2 else f"k{i % 5}", DAY0 + timedelta(days=int(d))) for i, d in enumerate(rng.integers(0, 300, 800))] + [(900, None, DAY0), (901, "hot", None)]
    right = [("hot", DAY0 + timedelta(days=int(d)), float(d)) for d in rng.choice(300, 200, replace=False)] + [(f"k{k}", DAY0 + timedelta(days=9 * k), float(k)) for k in range(3)]
    a = spark.createDataFrame(left, "id long, key string, date date")
    b = spark.createDataFrame(right, "key string, date date, v double")
    got = {r.id: r.v for r in P.asof_join(a, b, ["key"], ["v"], share_rows=share_rows).collect()}
    assert len(got) == len(left)
    for i, key, day in left:
        before = [(d, v) for k, d, v in right if k == key and day is not None and d <= day]
        assert got[i] == (max(before)[1] if before else None)


def test_a_hot_key_reaches_many_tasks(spark):
    a = spark.range(4000).select(F.col("id"), F.lit("hot").alias("key"), F.lit(DAY0).alias("date"))
    b = spark.createDataFrame([("hot", DAY0, 1.0)], "key string, date date, v double")
    dealt, copied = P._in_shares(a, b, ["key"], 500)
    assert dealt.groupBy("_share").count().count() == 8 == copied.count()
    assert dealt.groupBy("_share").count().agg(F.max("count")).first()[0] < 700


def _bars(spark, rows):
    return closes(spark, rows).select("series_id", "date", F.col("close").alias("open"), "close")


def test_two_loads_equal_one(spark):
    day = lambda k: DAY0 + timedelta(days=int(k))
    rows = [(s, day(k), float(k)) for s, days_ in {"a": range(0, 100, 3), "new": range(70, 100, 2), "gone": range(0, 30)}.items() for k in days_]
    bars = _bars(spark, rows)
    macro = [(s, 2, pos, day(q), 2020, 1, None if pos else float(q), float(q) if pos else None) for s in ("a", "new", "gone") for pos in (0, 1) for q in (0, 40, 60, 80)]
    macro += [("a", 2, 0, None, None, None, None, None), ("no_bars", 1, 0, day(5), 2020, 1, 1.0, None)]
    macro = spark.createDataFrame(macro, "series_id string, n_areas int, pos int, date date, obs_year int, obs_quarter int, macro_0 double, macro_1 double")
    lit = lambda k: F.lit(day(k))
    whole = combine(bars, macro, lit(0), lit(99))
    for middle in (0, 35, 59, 60, 98):
        first = combine(bars.where(F.col("date") <= lit(middle)), macro.where((F.col("date") <= lit(middle)) | F.col("date").isNull()), lit(0), lit(middle))
        second = extend_panel(panel_state(first, lit(middle)), bars, macro, lit(0), lit(middle), lit(99))
        got = first.unionByName(second)
        assert got.columns == whole.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr), middle


def test_mean_reversion_by_hand_and_on_a_simulated_path(spark):
    rng, theta, level, sigma = np.random.default_rng(11), 0.08, 50.0, 1.5
    at, x, path = 0, level, []
    for _ in range(4000):
        path.append(("p", DAY0 + timedelta(days=at), float(x)))
        for _ in range(gap := int(rng.integers(1, 4))):
            x += theta * (level - x) + sigma * rng.normal()
        at += gap
    few = [("few", DAY0 + timedelta(days=k), float(v)) for k, v in [(0, 1), (1, 3), (4, 2), (5, 2.5), (9, 1)]]
    rows = path + few + [("flat", DAY0 + timedelta(days=k), 4.0) for k in range(9)] + [("two", DAY0, 1.0), ("two", date(2020, 2, 1), 2.0), ("few", None, 9.0), ("few", date(2020, 3, 1), None)]
    got = {r.series_id: r for r in mean_reversion(closes(spark, rows)).collect()}
    assert got["p"].theta == pytest.approx(theta, rel=0.2) and got["p"].mean == pytest.approx(level, abs=1.5) and got["p"].sigma == pytest.approx(sigma, rel=0.1)
    days_, v = np.array([0, 1, 4, 5, 9.0]), np.array([1, 3, 2, 2.5, 1])
    gap, step = np.diff(days_), np.diff(v)
    design = np.column_stack([gap, v[:-1] * gap]) / np.sqrt(gap)[:, None]
    (a, b), rest, *_ = np.linalg.lstsq(design, step / np.sqrt(gap), rcond=None)
    r = got["few"]
    assert (r.n, r.theta, r.mean, r.sigma) == (4, pytest.approx(-b), pytest.approx(-a / b), pytest.approx(np.sqrt(rest[0] / 2)))
    assert r.half_life == pytest.approx(np.log(2) / -b)
    assert got["flat"].theta is None and got["flat"].n == 8 and got["two"].theta is None
