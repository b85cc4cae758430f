import numpy as np
import pandas as pd
import pytest

from panelcast.config import MAIN_CONFIG, ForecastConfig
from panelcast.operators import linear, ml, split
from panelcast.operators.features import feature_frame, prepare
from panelcast.plans import tables
from panelcast.plans.forecast import forecast_panel, scaled_inputs
from panelcast.session import materialize
from tests.helpers import DAY0


def _inputs(spark, sf):
    return materialize(scaled_inputs(feature_frame(prepare(tables.orders_binding(spark, sf).panel(), MAIN_CONFIG), MAIN_CONFIG), MAIN_CONFIG))


def _design(inputs, cfg, series):
    """Sequences newest row first, and a constant; the targets; which validate."""
    seqs = split.sequences(inputs, length=cfg.sequence_length).where(f"series_id = '{series}'").toPandas().sort_values("date")
    x = np.array([np.concatenate([np.pad(r, (0, cfg.k_best - len(r))) for r in s[::-1]]) for s in seqs.sequence])
    return np.column_stack([x, np.ones(len(x))]), seqs.target.to_numpy(), seqs.is_val_target.to_numpy(bool)


@pytest.fixture(scope="module")
def small(spark):
    """Two features of three slots, some rows, short parts."""
    rng, rows = np.random.default_rng(4), []
    for series, n, k in (("a", 40, 3), ("b", 23, 2), ("tiny", 9, 3)):
        rows += [(series, pd.Timestamp(DAY0) + pd.Timedelta(days=i), float(rng.normal()), rng.normal(size=k).tolist(), i >= n - 5) for i in range(n)]
    df = spark.createDataFrame([(s, d.date(), y, x, v) for s, d, y, x, v in rows], "series_id string, date date, target double, features array<double>, is_val_target boolean")
    return df, ForecastConfig(horizon=5, sequence_length=4, k_best=3)


@pytest.mark.parametrize("batches", [1, 3])
def test_gram_matrices_are_those_of_the_sequences(small, batches):
    df, cfg = small
    got = {(r.series_id, r.part): r for r in linear.gram_matrices(df, cfg, batches).collect()}
    assert {s for s, _ in got} == {"a", "b"}  # tiny has no training target
    for series in ("a", "b"):
        x, y, val = _design(df, cfg, series)
        n = (~val).sum()
        parts = {b: np.flatnonzero(~val)[n * b // batches : n * (b + 1) // batches] for b in range(batches)} | {linear.VALIDATION: np.flatnonzero(val)}
        for part, at in parts.items():
            r = got[series, part]
            np.testing.assert_allclose(r.gram, x[at].T @ x[at], atol=1e-12)
            np.testing.assert_allclose(r.cross, x[at].T @ y[at], atol=1e-12)
            assert r.n == len(at) and r.yy == pytest.approx(y[at] @ y[at])


def _plain_curve(x, y, val, optimizer, rate, batches, epochs):
    """Gradient descent on the rows themselves."""
    train = np.flatnonzero(~val)
    w, m, v, step, curve = np.zeros(x.shape[1]), 0.0, 0.0, 0, []
    for _ in range(epochs):
        for b in range(batches):
            at = train[len(train) * b // batches : len(train) * (b + 1) // batches]
            g, step = 2 * x[at].T @ (x[at] @ w - y[at]) / len(at), step + 1
            if optimizer == "sgd":
                w = w - rate * g
            elif optimizer == "momentum":
                m = 0.9 * m + g
                w = w - rate * m
            else:
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
        curve.append((((x[train] @ w - y[train]) ** 2).mean(), ((x[val] @ w - y[val]) ** 2).mean()))
    return np.array(curve)


def test_training_by_sums_is_training_by_rows(small):
    df, cfg = small
    lists = {"family": ["linear"], "optimizer": ["sgd", "momentum", "adam"], "rate": [0.05], "batches": [1, 2], "epochs": [3, 6]}
    curves = linear.trained_curves(df, cfg, lists).toPandas().sort_values(["series_id", "trial_id", "iteration"])
    for series in ("a", "b"):
        x, y, val = _design(df, cfg, series)
        for (trial, text), rows in curves[curves.series_id == series].groupby(["trial_id", "params_str"]):
            given = dict(p.split(": ") for p in text.split("; "))
            want = _plain_curve(x, y, val, given["optimizer"], 0.05, int(given["batches"]), int(given["epochs"]))
            assert rows.iteration.tolist() == list(range(1, len(want) + 1))
            np.testing.assert_allclose(rows[["train_loss", "val_loss"]], want, rtol=1e-9)
    assert curves.trial_id.nunique() == 12
    with pytest.raises(ValueError):
        linear.trained_curves(df, cfg, lists | {"batches": [2, 3]})


def test_patience(spark):
    losses = {0: [5, 4, 3, 3, 3.5, 2, 9], 1: [5, 4, 3, 3, 3.5, 3.1, 2], 2: [1, 2, 3], 3: [3, 2, 1], 4: [7]}
    curves = spark.createDataFrame([("s", t, "f", "p", i + 1, -float(x), float(x)) for t, xs in losses.items() for i, x in enumerate(xs)], "series_id string, trial_id int, family string, params_str string, iteration int, train_loss double, val_loss double")
    got = {r.trial_id: (r.stopped_at, r.best_iteration, r.train_loss, r.val_loss) for r in linear.early_stopping(curves, 3).collect()}
    assert got == {0: (7, 6, -2, 2), 1: (6, 3, -3, 3), 2: (3, 1, -1, 1), 3: (3, 3, -1, 1), 4: (1, 1, -7, 7)}


def test_learned_trials_join_the_leaderboard(spark, sf):
    run = forecast_panel(tables.orders_binding(spark, sf).panel(), MAIN_CONFIG, learned=True)
    board = run.leaderboard.toPandas()
    assert len(board) == 5 * (11 + 4 + 12) and set(board["rank"]) == set(range(1, 28))
    assert {p.split(";")[0] for p in board.parameters} == {"family: naive", "family: moving_average", "family: ols_lag", "family: ridge", "family: linear"}


def test_learned_models(spark, sf):
    cfg, inputs = MAIN_CONFIG, _inputs(spark, sf)

    ridge = linear.ridge_scores(inputs, cfg).toPandas().set_index(["series_id", "params_str"]).sort_index()
    x, y, val = _design(inputs, cfg, "1-URGENT")
    penalty = np.eye(x.shape[1])
    penalty[-1, -1] = 0
    beta = np.linalg.solve(x[~val].T @ x[~val] + penalty, x[~val].T @ y[~val])
    loss = ((y[val] - x[val] @ beta) ** 2).mean()
    assert np.isclose(ridge.loc[("1-URGENT", "family: ridge; alpha: 1.0"), "val_loss"], loss)
    assert np.isclose(ridge.loc[("1-URGENT", "family: ridge; alpha: 1.0"), "val_r2"], 1 - loss / y[val].var())
    assert len(ridge) == 5 * 4

    run = ml.pooled_grid(inputs, cfg)
    board = run.leaderboard.toPandas()
    assert len(board) == 5 * 4 and board.mean_mse.notna().all()
    assert run.forecast.count() == 5 * cfg.horizon

    curves: pd.DataFrame = ml.loss_curves(inputs, cfg).toPandas()
    spans = curves.groupby(["series_id", "family"]).iteration.agg(["min", "max"])
    assert len(spans) == 5 * 2 and spans["min"].eq(1).all() and spans["max"].eq(20).all()
    assert (curves[["train_loss", "val_loss"]] > 0).all().all()


def test_ridge_shuffles_rows_and_no_matrices(small):
    """Rows that Spark shuffles once by series; a Gram matrix takes more room than the rows of a series."""
    df, cfg = small
    ridge = linear.ridge_scores(df, cfg)
    plan = ridge._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "gram" not in plan and "Window" not in plan
    got = {(r.series_id, r.params_str): r.val_loss for r in ridge.collect()}
    assert {s for s, _ in got} == {"a", "b"} and len(got) == 8
    x, y, val = _design(df, cfg, "a")
    w = linear.ridge_solution(x[~val].T @ x[~val], x[~val].T @ y[~val], 10.0)
    assert got["a", "family: ridge; alpha: 10.0"] == pytest.approx(((y[val] - x[val] @ w) ** 2).mean())
