"""Linear forecasters of the scaled sequences, from sums of lagged cross-products.

The inputs of a target are the features of the ``sequence_length`` rows before
it and a constant, as in ``split.sequences``. What a fit needs of them is the
Gram matrix of each series and part of its targets. A series has at most one
row per calendar day, so its rows are laid out as sequences inside a task, one
series at a time, and only the sums leave it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.config import ForecastConfig
from panelcast.operators import grid
from panelcast.operators.grid import Trial
from panelcast.session import stored

RIDGE_GRID = {"ridge": {"alpha": [0.1, 1.0, 10.0, 100.0]}}
#: Every combination is a trial; ``batches`` is the number of consecutive parts of the training rows that an epoch goes through.
TRAINED_GRID = {"family": ["linear"], "optimizer": ["sgd", "momentum", "adam"], "rate": [0.002], "batches": [1, 4], "epochs": [20, 50]}
PATIENCE = 10
MOMENTUM, ADAM = 0.9, (0.9, 0.999, 1e-7)
VALIDATION = -1


def gram_matrices(inputs: DataFrame, cfg: ForecastConfig, batches: int = 1) -> DataFrame:
    """Sums of the design and the target of each series and part of its targets.

    ``series_id, part, n, yy, cross ARRAY, gram ARRAY<ARRAY>``: number of
    targets, their sum of squares, the inputs' products with the target and
    with each other. Inputs are ordered by lag, then feature, then the
    constant. Parts 0.. are consecutive batches of the training targets, part
    -1 the validation targets. ``inputs`` come from ``scaled_inputs``; a
    series with fewer features is padded with zeros, one without training
    targets has no row.
    """
    p = cfg.k_best * cfg.sequence_length + 1

    def sums(series: pa.Table) -> pa.Table:
        out = list(_part_sums(series, cfg, batches))
        if not out:
            return _SUMS.empty_table()
        part, n, yy, cross, gram = zip(*out, strict=True)
        cut = lambda count: pa.array(np.arange(count + 1, dtype=np.int32) * p)
        lines = pa.ListArray.from_arrays(cut(len(out) * p), pa.array(np.concatenate([g.ravel() for g in gram])))
        arrays = [pa.array([series["series_id"][0].as_py()] * len(out), pa.string()), pa.array(part, pa.int32()), pa.array(n, pa.int64()), pa.array(yy, pa.float64())]
        return pa.Table.from_arrays([*arrays, pa.ListArray.from_arrays(cut(len(out)), pa.array(np.concatenate(cross))), pa.ListArray.from_arrays(cut(len(out)), lines)], schema=_SUMS)

    return _series_rows(inputs, cfg).groupBy("series_id").applyInArrow(sums, "series_id string, part int, n long, yy double, cross array<double>, gram array<array<double>>")


_SUMS = pa.schema([("series_id", pa.string()), ("part", pa.int32()), ("n", pa.int64()), ("yy", pa.float64()), ("cross", pa.list_(pa.float64())), ("gram", pa.list_(pa.list_(pa.float64())))])


def _series_rows(inputs: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Day, target and features of each row, a missing feature as 0."""
    padded = F.slice(F.concat("features", F.array_repeat(F.lit(0.0), cfg.k_best)), 1, cfg.k_best)
    features = [F.coalesce(F.get(padded, F.lit(a)), F.lit(0.0)).alias(f"x{a}") for a in range(cfg.k_best)]
    return inputs.where(F.col("series_id").isNotNull()).select("series_id", F.unix_date("date").alias("day"), F.col("target").alias("y"), *features)


def _part_sums(series: pa.Table, cfg: ForecastConfig, batches: int) -> Iterator[tuple[int, int, float, np.ndarray, np.ndarray]]:
    """Part, number of targets, their sum of squares, products with the target, Gram matrix of one series."""
    length, total = cfg.sequence_length, series.num_rows
    n = total - cfg.horizon - length
    if n <= 0:
        return
    series = series.sort_by("day")
    seen, y = series["y"].is_valid().to_numpy(), series["y"].fill_null(0.0).to_numpy()
    x = np.column_stack([series[f"x{a}"].to_numpy() for a in range(cfg.k_best)])
    cuts = [length + n * b // batches for b in range(batches + 1)]
    for part, lo, hi in [*((b, cuts[b], cuts[b + 1]) for b in range(batches)), (VALIDATION, cuts[-1], total)]:
        if lo < hi:
            # the rows before each target, newest first, and the constant
            design = np.column_stack([*(x[lo - i : hi - i] for i in range(1, length + 1)), np.ones(hi - lo)])
            yield part, int(seen[lo:hi].sum()), float(y[lo:hi] @ y[lo:hi]), design.T @ y[lo:hi], design.T @ design


def ridge_solution(gram: np.ndarray, cross: np.ndarray, alpha: float) -> np.ndarray:
    """Weights of least squares with a penalty on all but the constant."""
    penalty = np.full(len(gram), alpha)
    penalty[-1] = 0
    return np.linalg.solve(gram + np.diag(penalty), cross)


def ridge_scores(inputs: DataFrame, cfg: ForecastConfig, lists: dict = RIDGE_GRID) -> DataFrame:
    """Validation loss and R² of every ridge trial of every series.

    The sums of a series are made and solved in one place, so that no matrix
    is shuffled.
    """
    trials = grid.expand_families(lists)
    schema = "series_id string, trial_id int, family string, params_str string, val_loss double, val_r2 double"

    def solve(series: pa.Table) -> pa.Table:
        held = {part: sums for part, *sums in _part_sums(series, cfg, 1)}
        out = []
        if len(held) == 2:
            (_, _, cross, gram), (n, yy, with_target, seen) = held[0], held[VALIDATION]
            spread = yy / n - (with_target[-1] / n) ** 2
            for trial in trials:
                w = ridge_solution(gram, cross, trial["alpha"])
                loss = (w @ seen @ w - 2 * w @ with_target + yy) / n
                out.append((series["series_id"][0].as_py(), trial.trial_id, trial.family, trial.text, loss, 1 - loss / spread if spread > 0 else float(loss == 0)))
        return pa.Table.from_pylist([dict(zip(_RIDGE.names, r, strict=True)) for r in out], schema=_RIDGE)

    return _series_rows(inputs, cfg).groupBy("series_id").applyInArrow(solve, schema)


_RIDGE = pa.schema([("series_id", pa.string()), ("trial_id", pa.int32()), ("family", pa.string()), ("params_str", pa.string()), ("val_loss", pa.float64()), ("val_r2", pa.float64())])


# --- training by gradient descent, folded in the plan -----------------------


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: lambdas share no subexpressions."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _times(gram: Column, w: Column) -> Column:
    return F.transform(gram, lambda r: _dot(r, w))


def _loss(sums: Column, w: Column) -> Column:
    """Mean squared error of weights on the targets behind the sums."""
    return (_dot(w, _times(sums["gram"], w)) - 2 * _dot(w, sums["cross"]) + sums["yy"]) / sums["n"]


def _moved(state: Column, gradient: Column, optimizer: Column, rate: Column) -> Column:
    """The state (w, m, v, step) after one step of the optimizer."""
    first, second, tiny = ADAM
    step = state["step"] + 1
    plain = lambda: F.struct(F.zip_with(state["w"], gradient, lambda w, g: w - rate * g).alias("w"), state["m"].alias("m"), state["v"].alias("v"), step.alias("step"))

    def momentum(m: Column) -> Column:
        return F.struct(F.zip_with(state["w"], m, lambda w, x: w - rate * x).alias("w"), m.alias("m"), state["v"].alias("v"), step.alias("step"))

    def adam(mv: Column) -> Column:
        m, v = mv["m"], mv["v"]
        change = F.zip_with(m, v, lambda x, y: (x / (1 - F.pow(F.lit(first), step))) / (F.sqrt(y / (1 - F.pow(F.lit(second), step))) + tiny))
        return F.struct(F.zip_with(state["w"], change, lambda w, x: w - rate * x).alias("w"), m.alias("m"), v.alias("v"), step.alias("step"))

    return (
        F.when(optimizer == "momentum", _let(F.zip_with(state["m"], gradient, lambda m, g: MOMENTUM * m + g), momentum))
        .when(optimizer == "adam", _let(F.struct(F.zip_with(state["m"], gradient, lambda m, g: first * m + (1 - first) * g).alias("m"), F.zip_with(state["v"], gradient, lambda v, g: second * v + (1 - second) * g * g).alias("v")), adam))
        .otherwise(plain())
    )


def _added(parts: Column) -> Column:
    """The sums of several batches together."""
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    rest = F.slice(parts, 2, F.size(parts))
    return F.aggregate(
        rest,
        F.get(parts, F.lit(0)),
        lambda s, p: F.struct((s["n"] + p["n"]).alias("n"), (s["yy"] + p["yy"]).alias("yy"), add(s["cross"], p["cross"]).alias("cross"), F.zip_with(s["gram"], p["gram"], add).alias("gram")),
    )


def trained_curves(inputs: DataFrame, cfg: ForecastConfig, lists: Mapping[str, Sequence] = TRAINED_GRID) -> DataFrame:
    """Training and validation loss after every epoch of every trial, nothing stopped.

    ``series_id, trial_id, family, params_str, iteration (1-based), train_loss,
    val_loss``. Weights start at 0; an epoch takes one step of the optimizer
    per batch, on the mean squared error of the batch. The descent is a fold
    over the batches' Gram matrices with the weights as its state, so its work
    does not depend on the series' length. Trials that differ in the number of
    epochs only share one path.
    """
    trials = grid.expand_product(lists, "family")
    most = max(t["batches"] for t in trials)
    if any(most % t["batches"] for t in trials):
        raise ValueError("each number of batches must divide the largest")
    sums = gram_matrices(inputs, cfg, most)
    entry = F.struct("part", F.col("n").cast("double").alias("n"), "yy", "cross", "gram")
    gathered = sums.groupBy("series_id").agg(F.array_sort(F.collect_list(entry)).alias("held"))
    plain = lambda p: F.struct(p["n"].alias("n"), p["yy"].alias("yy"), p["cross"].alias("cross"), p["gram"].alias("gram"))
    gathered = gathered.select("series_id", plain(F.get("held", F.lit(0))).alias("val"), F.transform(F.slice("held", 2, most), plain).alias("parts"))
    gathered = stored(gathered.withColumn("whole", _added(F.col("parts"))), "sums")

    paths: dict[tuple, list[Trial]] = {}
    for trial in trials:
        paths.setdefault((trial["optimizer"], trial["rate"], trial["batches"]), []).append(trial)
    listed = F.array(*[
        F.struct(
            F.lit(optimizer).alias("optimizer"), F.lit(float(rate)).alias("rate"), F.lit(batches).alias("batches"), F.lit(max(t["epochs"] for t in own)).alias("epochs"),
            F.array(*[F.struct(F.lit(t.trial_id).alias("trial_id"), F.lit(t.family).alias("family"), F.lit(t.text).alias("params_str"), F.lit(t["epochs"]).alias("epochs")) for t in own]).alias("trials"),
        )
        for (optimizer, rate, batches), own in paths.items()
    ])
    runs = gathered.select("*", F.inline(listed)).repartition("series_id", "optimizer", "rate", "batches")

    share = F.lit(most) / F.col("batches")
    merged = F.transform(F.sequence(F.lit(0), F.col("batches") - 1), lambda b: _added(F.slice("parts", (b * share).cast("int") + 1, share.cast("int"))))
    runs = runs.withColumn("batch_sums", F.when(F.col("batches") == 1, F.array("whole")).otherwise(merged))
    zeros = F.transform(F.col("val.cross"), lambda x: F.lit(0.0))
    start = F.struct(zeros.alias("w"), zeros.alias("m"), zeros.alias("v"), F.lit(0.0).alias("step"))
    curve_type = "array<struct<iteration:int,train_loss:double,val_loss:double>>"

    def one_batch(state: Column, sums: Column) -> Column:
        gradient = F.zip_with(_times(sums["gram"], state["w"]), sums["cross"], lambda a, c: 2 * (a - c) / sums["n"])
        return _let(gradient, lambda g: _moved(state, g, F.col("optimizer"), F.col("rate")))

    def one_epoch(held: Column, epoch: Column) -> Column:
        def after(state: Column) -> Column:
            point = F.struct(epoch.alias("iteration"), _loss(F.col("whole"), state["w"]).alias("train_loss"), _loss(F.col("val"), state["w"]).alias("val_loss"))
            return F.struct(state.alias("state"), F.concat(held["curve"], F.array(point)).alias("curve"))

        return _let(F.aggregate(F.col("batch_sums"), held["state"], one_batch), after)

    folded = F.aggregate(F.sequence(F.lit(1), F.col("epochs")), F.struct(start.alias("state"), F.array().cast(curve_type).alias("curve")), one_epoch, lambda held: held["curve"])
    curves = stored(runs.select("series_id", "trials", folded.alias("curve")), "curves")
    per_trial = curves.select("series_id", "curve", F.inline("trials"))
    points = per_trial.select("series_id", "trial_id", "family", "params_str", F.inline(F.slice("curve", F.lit(1), F.col("epochs"))))
    return points.select("series_id", "trial_id", "family", "params_str", "iteration", "train_loss", "val_loss")


def early_stopping(curves: DataFrame, patience: int = PATIENCE) -> DataFrame:
    """Where each trial would stop, and the loss of the weights it restores.

    ``series_id, trial_id, family, params_str, stopped_at, best_iteration,
    train_loss, val_loss``: training ends after ``patience`` epochs without a
    validation loss below the least so far, or with the last epoch; the
    weights of the best epoch until then are restored.
    """
    point = F.struct("iteration", "train_loss", "val_loss")
    per_trial = curves.groupBy("series_id", "trial_id", "family", "params_str").agg(F.array_sort(F.collect_list(point)).alias("curve"))

    def scan(state: Column, p: Column) -> Column:
        waited = p["iteration"] - state["best"]["iteration"]
        better = F.coalesce(p["val_loss"] < state["best"]["val_loss"], F.lit(True))
        moved = F.struct(F.when(better, p).otherwise(state["best"]).alias("best"), p["iteration"].alias("at"), (~better & (waited >= patience)).alias("done"))
        return F.when(state["done"], state).otherwise(moved)

    nothing = F.lit(None).cast("struct<iteration:int,train_loss:double,val_loss:double>")
    start = F.struct(nothing.alias("best"), F.lit(0).alias("at"), F.lit(False).alias("done"))
    scanned = per_trial.withColumn("end", F.aggregate("curve", start, scan))
    return scanned.select(
        "series_id", "trial_id", "family", "params_str", F.col("end.at").alias("stopped_at"), F.col("end.best.iteration").alias("best_iteration"),
        F.col("end.best.train_loss").alias("train_loss"), F.col("end.best.val_loss").alias("val_loss"),
    )


def trained_scores(stopped: DataFrame, inputs: DataFrame) -> DataFrame:
    """``early_stopping``'s trials in the columns of ``grid.grid_scores``."""
    spread = inputs.where("is_val_target").groupBy("series_id").agg(F.var_pop("target").alias("spread"))
    r2 = F.when(F.col("spread") > 0, 1 - F.col("val_loss") / F.col("spread")).otherwise((F.col("val_loss") == 0).cast("double"))
    return stopped.join(spread, "series_id").select("series_id", "trial_id", "family", "params_str", "val_loss", r2.alias("val_r2"))
