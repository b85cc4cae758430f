from dataclasses import replace
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.config import MAIN_CONFIG, ForecastConfig
from panelcast.operators import evaluate, grid, linear, scale, split, stats
from panelcast.operators.status import series_status
from panelcast.plans import tables
from panelcast.plans.forecast import forecast_panel, scaled_inputs
from panelcast.queries import QUERIES
from tests.helpers import DAY0, closes, column, days


def frame_of(spark, **columns):
    n = len(next(iter(columns.values())))
    rows = [("s", date.fromordinal(DAY0.toordinal() + i), *[float(c[i]) for c in columns.values()]) for i in range(n)]
    return spark.createDataFrame(rows, "series_id string, date date, " + ", ".join(f"{c} double" for c in columns))


def test_f_scores(spark):
    df = frame_of(spark, x=[1, 2, 3, 4, 5], c=[7] * 5, same=[2, 4, 5, 4, 5], target=[2, 4, 5, 4, 5])
    scores = {r.feature: r.f_score for r in stats.feature_scores(df, ["x", "c", "same"]).collect()}
    assert scores["x"] == pytest.approx(4.5) and scores["c"] == 0.0 and scores["same"] > 1e15
    top = stats.rank_features(stats.feature_scores(df, ["x", "c", "same"]), 1).collect()
    assert [r.feature for r in top] == ["same"]


def test_top_k_ties_prefer_the_later_column(spark):
    x = [1, 2, 3, 4, 5]
    df = frame_of(spark, a=x, b=x, c=x, target=[2, 4, 5, 4, 5])
    ranked = stats.rank_features(stats.feature_scores(df, ["a", "b", "c"]), 2)
    assert {r.feature for r in ranked.collect()} == {"b", "c"}
    for k, want in [(2, [1, 2]), (9, [0, 1, 2])]:
        chosen = stats.project_selected(stats.with_selection(df, ["a", "b", "c"], k), ["a", "b", "c"])
        assert chosen.first().selected == want
    assert stats.selected_long(chosen, ["a", "b", "c"]).count() == 15


def test_scores_on_training_rows_only(spark):
    df = frame_of(spark, x=[1, 2, 3, 4, 100], target=[2, 4, 5, 4, 5])
    part = stats.feature_scores(df, ["x"], on=F.col("date") < F.lit("2020-01-05").cast("date")).first().f_score
    r = np.corrcoef([1, 2, 3, 4], [2, 4, 5, 4])[0, 1]
    assert part == pytest.approx(r * r / (1 - r * r) * 2)


def test_correlation_with_nulls_and_constants(spark):
    rng = np.random.default_rng(0)
    x, y = rng.random(30), rng.random(30)
    df = frame_of(spark, x=x, y=y, c=[3] * 30).withColumn("y", F.when(F.col("date") > F.lit("2020-01-05").cast("date"), F.col("y")))
    cells = {(r.a, r.b): r.r for r in stats.correlation_matrix(df, ["x", "y", "c"]).collect()}
    assert len(cells) == 9
    assert cells["x", "y"] == cells["y", "x"] == pytest.approx(np.corrcoef(x[5:], y[5:])[0, 1])
    assert cells["x", "x"] == pytest.approx(1.0) and cells["c", "x"] is None and cells["c", "c"] is None


VALUES = [1.0, 2.0, 3.0, 4.0, 10.0]
SCALED = {
    "standard": [-0.9486833, -0.63245553, -0.31622777, 0, 1.8973666],
    "normalize": [0, 1 / 9, 2 / 9, 1 / 3, 1],
    "robust": [-1, -0.5, 0, 0.5, 3.5],
}


@pytest.mark.parametrize("method", ["standard", "normalize", "robust", "nonsense"])
def test_scalers(spark, method):
    df = closes(spark, days(VALUES, "a"), days([5.0] * 5, "b"))
    out = scale.scale_columns(df, ["close"], method, keep_state=["close"])
    np.testing.assert_allclose(column(out, "close", "a"), SCALED.get(method, SCALED["standard"]), atol=1e-7)
    assert column(out, "close", "b") == [0.0] * 5
    back = out.withColumn("back", scale.inverse_scale(F.col("close"), F.col("close_center"), F.col("close_scale")))
    np.testing.assert_allclose(column(back, "back", "a"), VALUES)
    settled = scale.scale_columns(df, ["close"], method, keep_state=["close"], settle=True)
    np.testing.assert_allclose(column(settled, "close", "a"), column(out, "close", "a"))
    state = scale.grouped_state(df, ["close"], method).where("series_id = 'a'").first()
    row = out.where("series_id = 'a'").first()
    assert (state.close_center, state.close_scale) == (pytest.approx(row.close_center), pytest.approx(row.close_scale))


def test_split(spark):
    frame = closes(spark, days([float(i) for i in range(20)], "s"), days([1.0] * 7, "short"))
    df = split.train_val_split(frame, horizon=4, length=3)
    t = lambda flag: column(df.where(flag), "t", "s")
    assert df.select("train_size").distinct().collect()[0][0] == 13 and df.where("series_id = 'short'").count() == 0
    assert t("is_train") == list(range(16)) and t("is_val") == list(range(13, 20))
    assert t("is_train_target") == list(range(3, 16)) and t("is_val_target") == list(range(16, 20))


def test_sequences(spark):
    df = closes(spark, days([0.0, 1.0, 2.0, 3.0, 4.0])).withColumn("features", F.array("close"))
    out = split.sequences(df, length=2).orderBy("date").collect()
    assert [(r.sequence, r.close) for r in out] == [([[0.0], [1.0]], 2.0), ([[1.0], [2.0]], 3.0), ([[2.0], [3.0]], 4.0)]


def test_grids():
    trials = grid.expand_product({"a": [1, 2], "b": ["x", "y"]}, "a")
    assert [t.text for t in trials] == ["a: 1; b: x", "a: 1; b: y", "a: 2; b: x", "a: 2; b: y"]
    assert len(grid.expand_product(linear.TRAINED_GRID, "family")) == 12
    assert [t.family for t in grid.expand_families(MAIN_CONFIG.grid)] == ["naive"] * 3 + ["moving_average"] * 4 + ["ols_lag"] * 4


def test_ranks_break_ties_by_order(spark):
    scores = spark.createDataFrame(
        [("s", 0, "a", "p0", 0.2, 0.0), ("s", 1, "b", "p1", 0.1, 0.0), ("s", 2, "b", "p2", 0.1, 0.0)],
        "series_id string, trial_id int, family string, params_str string, val_loss double, val_r2 double",
    )
    assert grid.best_trial(scores).first().trial_id == 1
    assert [r.trial_id for r in grid.best_per_family(scores).orderBy("family").collect()] == [0, 1]
    assert {r.parameters: r["rank"] for r in grid.leaderboard(scores).collect()} == {"p0": 3, "p1": 1, "p2": 2}


def test_best_iteration(spark):
    curve = spark.createDataFrame([("s", 0, i + 1, v) for i, v in enumerate([0.3, 0.1, 0.1, 0.2])], "series_id string, trial_id int, iteration int, val_loss double")
    assert grid.best_iteration(curve).first().best_iteration == 2


def test_grid_scores_match_numpy(spark):
    rng = np.random.default_rng(5)
    y, horizon, length = 100 + rng.normal(size=120).cumsum(), 15, 7
    frame = closes(spark, days(y.tolist())).withColumnRenamed("close", "target")
    trials = grid.expand_families({"naive": {"k": [1, 7]}, "moving_average": {"w": [3]}, "ols_lag": {"k": [2]}})
    got = {r.params_str: r for r in grid.grid_scores(grid.grid_predictions(frame, trials, horizon, length)).collect()}
    z = (y - y[:-horizon].mean()) / y[:-horizon].std()
    val, fit = np.arange(120 - horizon, 120), np.arange(length, 120 - horizon)
    slope, intercept = np.polyfit(z[fit - 2], z[fit], 1)
    predictions = {
        "family: naive; k: 1": z[val - 1],
        "family: naive; k: 7": z[val - 7],
        "family: moving_average; w: 3": (z[val - 1] + z[val - 2] + z[val - 3]) / 3,
        "family: ols_lag; k: 2": intercept + slope * z[val - 2],
    }
    assert got.keys() == predictions.keys()
    for name, p in predictions.items():
        loss = ((z[val] - p) ** 2).mean()
        assert got[name].val_loss == pytest.approx(loss, rel=1e-9)
        assert got[name].val_r2 == pytest.approx(1 - loss / z[val].var(), rel=1e-9)


def test_trials_may_not_look_past_the_context(spark):
    frame = closes(spark, days([1.0] * 30)).withColumnRenamed("close", "target")
    with pytest.raises(ValueError):
        grid.grid_predictions(frame, grid.expand_families({"naive": {"k": [5]}}), 3, 4)


def test_smoothing(spark):
    df = frame_of(spark, predicted=[1, 2, 3, 4, 5, 6], actual=[0] * 6, target_center=[10] * 6, target_scale=[2] * 6)
    out = evaluate.smooth_predictions(df)
    assert column(out, "predicted") == [10 + 2 * v for v in (1, 1.5, 2, 2.5, 3, 4)] and column(out, "actual") == [10.0] * 6


@pytest.mark.parametrize("actual,predicted,want", [([1, 2, 3], [1, 2, 4], (1 / 3, 0.577350269, 0.5)), ([2, 2], [2, 2], (0, 0, 1)), ([2, 2], [2, 3], (0.5, 0.5**0.5, 0))])
def test_metrics(spark, actual, predicted, want):
    row = evaluate.forecast_metrics(frame_of(spark, actual=actual, predicted=predicted)).first()
    assert (row.mse, row.rmse, row.r2) == pytest.approx(want)


def test_histogram(spark):
    rows = evaluate.histogram(frame_of(spark, residual=[0, 1, 2, 3]), "residual", 3).orderBy("bin").collect()
    assert [r.n for r in rows] == [1, 1, 2] and [r.low for r in rows] == [0, 1, 2]
    same = evaluate.histogram(frame_of(spark, residual=[5, 5]), "residual", 2).orderBy("bin").collect()
    assert [(r.low, r.high, r.n) for r in same] == [(4.5, 5.0, 0), (5.0, 5.5, 2)]


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(2).normal(size=500)
    got = [r.n for r in evaluate.histogram(frame_of(spark, residual=x), "residual").orderBy("bin").collect()]
    assert got == np.histogram(x, 30)[0].tolist()


def test_panel_forecast(spark, sf):
    panel = tables.orders_binding(spark, sf).panel()
    run = forecast_panel(panel, MAIN_CONFIG, reuse=True)
    trials = len(grid.expand_families(MAIN_CONFIG.grid))
    ranks = run.leaderboard.groupBy("series_id").agg(F.sort_array(F.collect_list("rank")).alias("r")).collect()
    assert len(ranks) == 5 and all(r.r == list(range(1, trials + 1)) for r in ranks)
    assert run.forecast.count() == 5 * MAIN_CONFIG.horizon
    best = {r.series_id: r.params_str for r in run.best.collect()}
    assert best == {r.series_id: r.parameters for r in run.leaderboard.where("rank = 1").collect()}
    n = {r.series_id: r["count"] for r in run.frame.groupBy("series_id").count().collect()}
    kinds = {(r.series_id, r.kind): r["count"] for r in run.report.groupBy("series_id", "kind").count().collect()}
    h, length = MAIN_CONFIG.horizon, MAIN_CONFIG.sequence_length
    assert all(kinds[s, "train"] == n[s] - h - length and kinds[s, "predicted"] == h for s in n)
    inputs = scaled_inputs(run.frame, MAIN_CONFIG)
    seqs = split.sequences(inputs, length=length)
    assert {r.series_id: r["count"] for r in seqs.groupBy("series_id").count().collect()} == {s: c - length for s, c in n.items()}
    assert inputs.select(F.size("features").alias("k")).distinct().collect()[0].k == MAIN_CONFIG.k_best


def test_other_forecast_types_are_refused(spark, sf):
    with pytest.raises(ValueError):
        forecast_panel(tables.orders_binding(spark, sf).panel(), ForecastConfig(forecasting_type="direct"))


def test_status(spark):
    """Every status, over rows that prepare() would leave."""
    cfg = ForecastConfig(horizon=4, sequence_length=3, short_lag=1, long_lag=5, n_years=50)
    series = spark.createDataFrame([(n,) for n in ("ok", "none", "short", "zero", "few", "gap", "brief")], "series_id string")
    rising = lambda n, name: days([1.0 + k for k in range(n)], name)
    prepared = closes(spark, rising(30, "ok"), rising(5, "short"), days([0.0], "zero"), rising(12, "few"), rising(9, "gap"), rising(9, "brief"))
    reason = {"zero": "not_positive", "gap": "has_null", "brief": "too_short"}
    status = F.coalesce(F.create_map(*[F.lit(x) for pair in reason.items() for x in pair])[F.col("series_id")], F.lit("ok"))
    prepared = prepared.withColumn("decompose_status", status)
    got = {r.series_id: r for r in series_status(series, prepared, cfg).collect()}
    assert {k: r.status for k, r in got.items()} == reason | {"ok": "ok", "none": "no_data", "short": "no_features", "few": "not_enough_train"}
    assert (got["ok"].n_days, got["ok"].n_features, got["ok"].train_size) == (30, 25, 18)
    odd = replace(cfg, forecasting_type="direct")
    assert series_status(series, prepared, odd).where("series_id = 'ok'").first().status == "invalid_forecasting_type"
    assert series_status(series, prepared, replace(cfg, horizon=0)).where("series_id = 'ok'").first().status == "no_validation"


def test_the_product_grid_lists_every_network(spark, tmp_path):
    rows = [(1, 1, "O", 1.0, datetime(1996, 1, 1), "a"), (2, 1, "O", 1.0, datetime(1996, 1, 2), "b")]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/orders.parquet")
    got = QUERIES["grid_product"](spark, str(tmp_path)).toPandas()
    assert got.groupby("series_id").trial_id.nunique().to_dict() == {"a": 24, "b": 24}
    assert set(got.family) == {"LSTM", "GRU", "SimpleRNN"} and got.params_str.nunique() == 24
