import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.config import ForecastConfig, MAIN_CONFIG
from panelcast.functions.noise import day_number, gaussian
from panelcast.operators import features
from panelcast.operators.decompose import decompose, decomposition_long, seasonal_adjust
from panelcast.plans import tables
from tests.helpers import closes, column, days


def numpy_decompose(x, period):
    x, n, half = np.asarray(x, float), len(x), period // 2
    weights = np.array([0.5] + [1] * (period - 1) + [0.5]) / period if period % 2 == 0 else np.ones(period) / period
    trend = np.full(n, np.nan)
    trend[half : n - half] = np.convolve(x, weights, "valid")
    ratio = x / trend
    factors = np.array([np.nanmean(ratio[i::period]) for i in range(period)])
    seasonal = np.tile(factors / factors.mean(), n // period + 1)[:n]
    return trend, seasonal, x / trend / seasonal


def test_small_decomposition(spark):
    df = seasonal_adjust(decompose(closes(spark, days([2.0, 4.0] * 3)), period=2))
    assert column(df, "trend") == [None, 3, 3, 3, 3, None]
    np.testing.assert_allclose(column(df, "seasonal"), [2 / 3, 4 / 3] * 3)
    np.testing.assert_allclose(column(df, "seasonal_adjusted_close"), [3] * 6)
    np.testing.assert_allclose(column(df, "resid")[1:5], [1] * 4)
    assert decomposition_long(df.select("series_id", "date", "close", "trend", "seasonal", "resid")).count() == 24


@pytest.mark.parametrize("period", [12, 7, 252])
def test_decomposition_matches_numpy(spark, period):
    rng = np.random.default_rng(period)
    values = (100 + 0.1 * np.arange(700) + 10 * np.sin(np.arange(700) * 2 * np.pi / period) + rng.random(700)).tolist()
    df = decompose(closes(spark, days(values)), period=period)
    trend, seasonal, resid = numpy_decompose(values, period)
    for name, want in [("trend", trend), ("seasonal", seasonal), ("resid", resid)]:
        got = np.array([np.nan if v is None else v for v in column(df, name)])
        np.testing.assert_allclose(got, want, rtol=1e-11)
    first_cycle = column(df, "seasonal")[:period]
    assert math.isclose(np.mean(first_cycle), 1.0)


def test_invalid_series_get_a_status_and_leave_others_alone(spark):
    good = [float(10 + i % 2) for i in range(8)]
    df = closes(
        spark, days(good, "good"), days([0.0] + good, "zero"), days([1.0, None] + good, "null"), days([1.0, 2.0, 3.0], "short")
    )
    out = decompose(df, period=2 * 2)
    status = {r.series_id: r.decompose_status for r in out.select("series_id", "decompose_status").distinct().collect()}
    assert status == {"good": "ok", "zero": "not_positive", "null": "has_null", "short": "too_short"}
    assert all(v is None for v in column(out, "seasonal", "zero"))
    assert all(v is not None for v in column(out, "seasonal", "good"))


def test_entropy(spark):
    df = features.price_entropy(closes(spark, days([5.0] * 4, "a"), days([1.0, 2.0, 3.0, 4.0], "b")))
    assert column(df, "entropy", "a") == pytest.approx([1.9999999994229218] * 4, abs=1e-14)
    assert column(df, "entropy", "b") == pytest.approx([1.8464393440939375] * 4, abs=1e-14)


def test_moments(spark):
    row = features.close_moments(closes(spark, days([1.0, 2.0, 4.0]))).first()
    assert (row.n, row.total) == (3, 7.0) and row["std"] == pytest.approx(np.std([1, 2, 4], ddof=1))


def test_draws_are_normal_and_do_not_depend_on_partitioning(spark):
    rows = spark.range(40_000).select(F.col("id").cast("string").alias("s"), F.to_date(F.lit("2020-01-01")).alias("d"))
    draws = lambda df, name: df.select("s", gaussian(42, name, F.col("s"), day_number(F.col("d"))).alias("z"))
    a = {r.s: r.z for r in draws(rows, "ou").collect()}
    b = {r.s: r.z for r in draws(rows.repartition(7), "ou").collect()}
    assert a == b
    z, other = np.array([a[k] for k in sorted(a)]), draws(rows, "random").toPandas().sort_values("s").z.to_numpy()
    assert abs(z.mean()) < 0.02 and abs(z.std() - 1) < 0.02
    assert abs(np.corrcoef(z, other)[0, 1]) < 0.02
    assert abs((np.abs(z) < 1.96).mean() - 0.95) < 0.01


def recurrence(z, mu, sigma, theta, horizon, n):
    dt, x = horizon / n, [mu]
    for t in range(1, n):
        x.append(x[-1] + theta * (mu - x[-1]) * dt + sigma * math.sqrt(dt) * z[t])
    return x


@pytest.mark.parametrize("theta,horizon", [(0.1, 1.0), (5.0, 2.0), (0.0, 1.0)])
def test_ou_noise_equals_the_recurrence(spark, theta, horizon):
    values = [10.0 + math.sin(i) for i in range(400)]
    df = closes(spark, days(values))
    z = column(df.withColumn("z", gaussian(7, "ou", F.col("series_id"), day_number(F.col("date")))), "z")
    got = column(features.ou_noise(df, theta, horizon, seed=7), "ou_simulated")
    want = recurrence(z, np.mean(values), np.std(values, ddof=1), theta, horizon, 400)
    np.testing.assert_allclose(got, want, rtol=1e-10)


def test_the_recurrence_itself():
    got = recurrence([None, 1, -1, 0.5, 0], 10, 2, 0.1, 1, 5)
    np.testing.assert_allclose(got, [10, 10.894427191, 9.982111456, 10.429682823, 10.421089166])


def test_ou_noise_refuses_ranges_it_cannot_hold(spark):
    with pytest.raises(ValueError):
        features.ou_noise(closes(spark, days([1.0, 2.0])), theta=600.0)


@pytest.fixture(scope="module")
def prepared(spark, sf):
    return features.prepare(tables.orders_binding(spark, sf).panel(), MAIN_CONFIG)


def test_prepare_equals_the_separate_operators(spark, sf, prepared):
    closes_only = prepared.select("series_id", "date", "close")
    parts = seasonal_adjust(decompose(closes_only)).select("series_id", "date", "seasonal_adjusted_close")
    parts = parts.join(features.price_entropy(closes_only).drop("close"), ["series_id", "date"])
    parts = parts.join(features.random_component(closes_only, 42).drop("close"), ["series_id", "date"])
    parts = parts.join(features.ou_noise(closes_only, 0.1, seed=42).drop("close"), ["series_id", "date"])
    names = ["seasonal_adjusted_close", "entropy", "random_component", "ou_simulated"]
    a = prepared.select("series_id", "date", *names).toPandas().sort_values(["series_id", "date"])
    b = parts.select("series_id", "date", *names).toPandas().sort_values(["series_id", "date"])
    np.testing.assert_allclose(a[names].to_numpy(), b[names].to_numpy(), rtol=1e-9)


def test_feature_frame_variants(prepared):
    full = features.feature_frame(prepared, MAIN_CONFIG)
    assert full.columns == [
        "series_id", "date", "close_lag_7", "close_lag_30", "ma_5", "month", "day_of_week", "quarter", "sin_month", "cos_month",
        "entropy", "random_component", "ou_simulated", "seasonal_adjusted_close", "macro_0", "macro_1", "n_areas", "target",
    ]
    strict = features.feature_frame(prepared, MAIN_CONFIG, "strict")
    assert "seasonal_adjusted_close" not in strict.columns
    basic = features.feature_frame(prepared, MAIN_CONFIG, "basic")
    assert basic.columns == ["series_id", "date", "close_lag_7", "close_lag_30", "ma_5", "macro_0", "macro_1", "n_areas", "target"]
    # The series mapped only to the base area keeps its rows although its second macro column is empty.
    alone = full.where("series_id = '2-HIGH'")
    assert alone.count() > 0 and alone.where("macro_1 is not null").count() == 0


def test_lags_start_inside_the_last_years(prepared):
    cfg = ForecastConfig(n_years=2, short_lag=3, long_lag=10)
    first = features.feature_frame(prepared, cfg).groupBy("series_id").agg(F.min("date").alias("d")).collect()
    last = prepared.groupBy().agg(F.max("date")).first()[0]
    assert {(r.d - last.replace(year=last.year - 2)).days for r in first} == {10}
