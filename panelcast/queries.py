"""The query registry: every entry reads the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from panelcast.config import MAIN_CONFIG
from panelcast.functions.dates import calendar_columns, seasonal_columns
from panelcast.operators import evaluate, features, grid, linear, long_series as long, macro, ml, panel as P, reversion, scale, split, stats
from panelcast.operators.clean import normalize_bars
from panelcast.operators.combine import combine
from panelcast.operators.decompose import decompose, decomposition_long, seasonal_adjust
from panelcast.operators.incremental import extend_panel, panel_state
from panelcast.operators.quantiles import exact_quantiles
from panelcast.operators.status import series_status
from panelcast.plans import tables as B
from panelcast.plans.forecast import ForecastPlan, forecast_panel, scaled_inputs
from panelcast.schema import drop_string_columns, numeric_columns
from panelcast.session import move, new_path, stored
from panelcast.sources.files import (
    file_manifest, load_bars, order_report, read_dated_csv, read_table, rejected_rows, replace_table, require_order, scan_dated_csv, verified_manifest, write_panel, write_results,
)
from panelcast.sources.sdmx import read_sdmx, write_sdmx

Query = Callable[[SparkSession, str], DataFrame]
CFG = MAIN_CONFIG

# Digits kept for columns of price size; everything else keeps 6.
PRICE_SIZED = {
    "trend": 5,
    "total": 2,
    "mean": 4,
    "std": 4,
    "random_component": 3,
    "ou_simulated": 3,
    "seasonal_adjusted_close": 3,
    "predicted": 3,
    "residual": 3,
    "low": 3,
    "high": 3,
    "value": 3,
    "rmse": 3,
    "f_score": 3,
}

# Parameter lists of the recurrent-network grid (fixed values).
NETWORK_GRID = {
    "rnn_type": ["LSTM", "GRU", "SimpleRNN"],
    "n_layers": [1, 2],
    "units": [50],
    "activation": ["relu", "tanh"],
    "optimizer": ["adam"],
    "batch_size": [32],
    "epochs": [20, 50],
    "dropout": [0.0],
}


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round doubles so that two engines' summation orders compare equal.

    floor(x * 10^d + 1/2) / 10^d stays in generated code; ``round`` goes
    through a decimal text per value.
    """
    places = PRICE_SIZED | digits

    def half_up(name: str) -> Column:
        unit = float(10 ** places.get(name, 6))
        return F.floor(F.col(name) * unit + 0.5) / unit

    return df.withColumns({f.name: half_up(f.name) for f in df.schema if isinstance(f.dataType, T.DoubleType)})


def significant(value: Column, digits: int = 7) -> Column:
    """The value to so many digits, whatever its size."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(value)) - (digits - 1))
    return F.when(value > 0, F.floor(value / unit + 0.5) * unit).otherwise(value)


# --- scans and bars -------------------------------------------------------


def ohlcv_daily(spark, sf):
    return B.order_bars(spark, sf)


def ohlcv_events(spark, sf):
    return rounded(B.event_bars(spark, sf))


def _downloaded(spark, sf) -> str:
    """The bars written as CSV in a downloaded table's layout: capital names, calendar columns, some junk cells."""
    path, day, date = new_path(spark, "bars"), F.dayofmonth("date"), F.col("date")
    junk = lambda c, k: F.when(day % 13 == k, "n/a").otherwise(F.col(c).cast("string"))
    bars = B.order_bars(spark, sf).select(
        "series_id", F.when(day == 31, F.lit("Total")).otherwise(date.cast("string")).alias("Date"), F.year(date).alias("Year"), F.month(date).alias("Month"),
        F.date_format(date, "EEEE").alias("Day_of_week"), F.col("volume").alias("Volume"), junk("close", 5).alias("Adj Close"),
        *[F.col(c).alias(c.capitalize()) for c in ("close", "high", "low")], junk("open", 7).alias("Open"),
    )
    write_panel(bars, path, "csv")
    return path


def load_dated_table(spark, sf):
    return load_bars(spark, _downloaded(spark, sf), series_from="column")


def rejected_cells(spark, sf):
    return rejected_rows(scan_dated_csv(spark, _downloaded(spark, sf), series_from="column"))


def _mixed_layouts(spark, sf) -> str:
    """The bars as CSV files, a folder per series, in one of three layouts; some odd lines and a broken archive among them."""
    path = new_path(spark, "layouts")
    bars, day = B.order_bars(spark, sf), F.dayofmonth("date")
    kind = F.pmod(F.substring("series_id", 1, 1).cast("int"), F.lit(3))
    text = lambda *cells: F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells])
    series, date, close, open_, volume = (F.col(c) for c in ("series_id", "date", "close", "open", "volume"))
    layouts = [
        ("Date,Close,Open,Volume,series_id", text(date, close, open_, volume, series)),
        ("series_id,volume,open,close,date", text(series, volume, open_, close, date)),
        ("Date,series_id,Adj Close,Close", text(date, series, close, close)),
    ]
    for k, (header, line) in enumerate(layouts):
        line = F.when(day == 13, F.concat(line, F.lit(",more"))).when(day == 14, F.substring_index(line, ",", 2)).otherwise(line)
        rows = bars.where(kind == k).select("series_id", F.lit(1).alias("_at"), line.alias("value"))
        heads = bars.where(kind == k).select("series_id").distinct().select("series_id", F.lit(0).alias("_at"), F.lit(header).alias("value"))
        lines = heads.unionByName(rows).repartition("series_id").sortWithinPartitions("series_id", "_at").drop("_at")
        lines.withColumnRenamed("series_id", "own").write.partitionBy("own").text(f"{path}/{k}")
    # text under the name of an archive
    bars.limit(1).select(F.lit("this is no archive")).coalesce(1).write.text(f"{path}/broken")
    part = next(r["path"] for r in spark.read.format("binaryFile").load(f"{path}/broken").select("path").collect())
    move(spark, part, f"{path}/broken/bars.csv.gz")
    return path


def file_layouts(spark, sf):
    """The manifest of a folder of mixed layouts, by header and status."""
    found = file_manifest(spark, _mixed_layouts(spark, sf))
    return found.groupBy(F.array_join("header", ",").alias("header"), "status").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_lines").alias("n_lines"), F.sum("n_wrong").alias("n_wrong"))


def load_layouts(spark, sf):
    """The dated lines of a folder of mixed layouts."""
    return read_dated_csv(spark, _mixed_layouts(spark, sf), series_from="column").select("series_id", "date", "open", "close", "adj_close", "volume")


def rejected_lines(spark, sf):
    return rejected_rows(scan_dated_csv(spark, _mixed_layouts(spark, sf), series_from="column"))


def restarted_sink(spark, sf):
    """The manifest of the bars' table after a first load that lacked some years and had others wrong."""
    path, bars = new_path(spark, "table"), B.order_bars(spark, sf)
    year = F.year("date")
    early = bars.where(year <= 1998).withColumn("close", F.when(year == 1996, F.col("close") + 1).otherwise(F.col("close")))
    extra = bars.limit(1).withColumn("date", F.lit("1970-01-01").cast("date"))  # a year that goes again
    replace_table(early.unionByName(extra), path)
    replace_table(bars, path)
    return verified_manifest(spark, path, bars.schema)


def macro_sink(spark, sf):
    """The daily macro columns of each series written as a table and read back."""
    path, rows = new_path(spark, "macro"), macro.macro_for_series(B.priority_map(spark, sf, unknown=True), B.macro_obs(spark, sf), None, *B.order_days(spark, sf))
    replace_table(rows, path)
    return rounded(read_table(spark, path, rows.schema))


def sink_order(spark, sf):
    """Rows out of order in the files of the bars' table, by year."""
    path = new_path(spark, "ordered")
    replace_table(B.order_bars(spark, sf), path)
    return require_order(order_report(spark, f"{path}/data", {"series_id": "string", "date": "date"}, "span")).select("span", "n_rows", "n_inside", "n_across")


def combined_sink(spark, sf):
    """The combined panel written and read back."""
    path = new_path(spark, "combined")
    panel = _orders_panel(spark, sf)
    write_panel(panel, path)
    return rounded(spark.read.schema(panel.schema).parquet(path), low=6, high=6)


def results_sink(spark, sf):
    """The ranked trials written as CSV over an earlier run's, and read back."""
    path = new_path(spark, "results")
    board = stored(_plan(spark, sf).leaderboard, "board")
    write_results(board.where("rank > 3"), path)
    write_results(board, path, replace=True)
    return rounded(spark.read.schema(board.schema).option("header", True).csv(path), rmse=6)


def raw_download(spark, sf) -> DataFrame:
    """Orders dressed as a raw download: odd column names, junk date cells."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    date = (
        F.when(key % 13 == 0, F.concat(F.lit("Ticker "), "o_orderpriority"))
        .when(key % 17 == 0, F.lit(None))
        .when(key % 19 == 0, F.lit("not a date"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )
    prices = {f"{c}_X": price for c in ("Open", "High", "Low", "Close")}
    return B.table(spark, sf, "orders").select(
        date.alias("Datetime"),
        F.col("o_orderpriority").alias("series_id"),
        *[c.alias(n) for n, c in prices.items()],
        F.lit(1.0).alias("Volume_X"),
        F.lit(0.0).alias("Dividends"),
    )


def normalize(spark, sf):
    return normalize_bars(raw_download(spark, sf), add_day_name=True)


def calendar_densify(spark, sf):
    return P.densify(B.order_bars(spark, sf), *B.order_days(spark, sf))


def forward_fill(spark, sf):
    return P.forward_fill(calendar_densify(spark, sf))


def calendar(spark, sf):
    df = calendar_columns(P.densify(B.order_bars(spark, sf).select("series_id", "date"), *B.order_days(spark, sf)))
    return df.withColumn("day_of_week", F.weekday("date"))


def seasonal_features(spark, sf):
    days = P.densify(B.order_bars(spark, sf).select("series_id", "date"), *B.order_days(spark, sf))
    return rounded(seasonal_columns(days))


# --- macro ------------------------------------------------------------------


def macro_filter(spark, sf):
    obs = B.macro_obs(spark, sf)
    return rounded(macro.request(obs, ["AMERICA", "ASIA", "EUROPE"], "1997-Q1"), value=6)


def macro_period_parse(spark, sf):
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    good = F.format_string("%d-Q%d", F.year(date), F.quarter(date))
    period = (
        F.when(key % 7 == 0, F.year(date).cast("string"))
        .when(key % 11 == 0, F.concat(F.year(date).cast("string"), F.lit("-Q5")))
        .when(key % 13 == 0, F.lit(""))
        .otherwise(good)
    )
    return macro.parse_periods(B.table(spark, sf, "orders").select("o_orderkey", period.alias("period")))


def macro_pivot(spark, sf):
    wide = macro.pivot_areas(B.macro_obs(spark, sf, by="nation"))
    return rounded(wide)


def macro_for_series(spark, sf):
    mapping = B.priority_map(spark, sf, unknown=True)
    return rounded(macro.macro_for_series(mapping, B.macro_obs(spark, sf), None, *B.order_days(spark, sf)))


def missing_areas(spark, sf):
    return macro.missing_areas(B.priority_map(spark, sf, unknown=True), B.macro_obs(spark, sf))


def macro_asof(spark, sf):
    """Every order with the growth of its priority's region known on its day."""
    own = F.create_map(*[F.lit(x) for p, a in B.PRIORITY_AREAS.items() for x in (p, a[0])])
    orders = B.table(spark, sf, "orders").select(
        "o_orderkey", F.coalesce(own[F.col("o_orderpriority")], F.lit(B.BASE_AREA)).alias("area"), F.to_date("o_orderdate").alias("date")
    )
    obs = B.macro_obs(spark, sf).where(F.col("value").isNotNull())
    return rounded(P.asof_join(orders, obs, ["area"], ["value"], settle=True), value=6)


def asof_hot(spark, sf):
    """Orders with the last bar of their key, where one key has half of the orders and of the bars."""
    hot = lambda c, own: F.when(F.col(c) % 2 == 0, F.lit("hot")).otherwise(own)
    orders = B.table(spark, sf, "orders").select("o_orderkey", hot("o_orderkey", F.col("o_orderpriority")).alias("key"), F.to_date("o_orderdate").alias("date"))
    lines = B.supplier_bars(spark, sf).select(F.col("series_id").cast("long").alias("id"), "date", "close")
    priority = F.get(F.array(*map(F.lit, B.PRIORITIES)), (F.floor(F.col("id") / 2) % 5).cast("int"))
    right = lines.groupBy(hot("id", priority).alias("key"), "date").agg(F.max("close").alias("close"))
    return P.asof_join(orders, right, ["key"], ["close"], share_rows=500)


def sdmx_observations(spark, sf):
    path = new_path(spark, "sdmx")
    write_sdmx(B.raw_macro(spark, sf), path, F.col("period"), F.col("area"), F.coalesce("value", F.lit("")))
    return rounded(macro.parse_macro(read_sdmx(spark, path)), value=6)


# --- panel and features -------------------------------------------------------


def _orders_panel(spark, sf):
    return B.orders_binding(spark, sf).panel()


def combined_panel(spark, sf):
    return rounded(_orders_panel(spark, sf), low=6, high=6)


def incremental_panel(spark, sf):
    """The combined panel loaded in two halves, the second from the first one's last rows."""
    bars, (start, end) = B.order_bars(spark, sf), B.order_days(spark, sf)
    mapped = macro.routed_macro(B.priority_map(spark, sf), B.macro_obs(spark, sf))
    middle = F.lit("1998-05-17").cast("date")
    first = stored(combine(bars.where(F.col("date") <= middle), mapped.where((F.col("date") <= middle) | F.col("date").isNull()), start, middle), "first-half")
    state = stored(panel_state(first, middle), "state")
    return rounded(first.unionByName(extend_panel(state, bars, mapped, start, middle, end)), low=6, high=6)


def closing_prices(spark, sf):
    return _orders_panel(spark, sf).select("series_id", "date", "close")


def wide_close(spark, sf):
    filled = P.densify(B.order_bars(spark, sf).select("series_id", "date", "close"), *B.order_days(spark, sf), fill=True)
    return P.to_wide(filled)


def _closes(spark, sf):
    days = P.densify(B.order_bars(spark, sf).select("series_id", "date", "close"), *B.order_days(spark, sf), fill=True)
    return days.where(F.col("close").isNotNull())


def last_n_years(spark, sf):
    return features.last_n_years(_closes(spark, sf), 3)


def lag_features(spark, sf):
    return features.lag_features(_closes(spark, sf), [7, 30])


def ma5(spark, sf):
    return rounded(features.moving_average(_closes(spark, sf), 5), ma_5=4)


def seasonal_decompose(spark, sf):
    return rounded(decompose(_closes(spark, sf)))


def decomposition_report(spark, sf):
    return rounded(decomposition_long(decompose(_closes(spark, sf))), value=5)


def seasonal_adjusted(spark, sf):
    df = seasonal_adjust(decompose(_closes(spark, sf)))
    return rounded(df.select("series_id", "date", "close", "seasonal_adjusted_close"))


def close_moments(spark, sf):
    return rounded(features.close_moments(_closes(spark, sf)))


def price_entropy(spark, sf):
    return rounded(features.price_entropy(_closes(spark, sf)))


def random_component(spark, sf):
    return rounded(features.random_component(_closes(spark, sf), CFG.seed))


def ou_noise(spark, sf):
    return rounded(features.ou_noise(_closes(spark, sf), CFG.theta, seed=CFG.seed))


def mean_reversion(spark, sf):
    return rounded(reversion.mean_reversion(B.order_bars(spark, sf)), mean=2, sigma=2, half_life=4)


def supplier_mean_reversion(spark, sf):
    return rounded(reversion.mean_reversion(B.supplier_bars(spark, sf)), mean=2, sigma=2, half_life=4)


def long_series(spark, sf):
    """All events as one series: filled values, running sum, trailing mean and centred trend, in many tasks."""
    events = B.table(spark, sf, "events").select(F.lit("all").alias("series_id"), "ts", "event_id", F.when(F.col("event_id") % 7 > 0, F.round(F.col("value") * 100).cast("long")).alias("cents"))
    rows = events.count()
    size = max(256, rows // 16)  # several blocks at any size
    blocks = long.in_blocks(events, ["ts", "event_id"], size)
    df = long.carried_sum(long.carried_fill(blocks, {"filled": "cents"}), {"running": F.col("cents")})
    df = long.moving_average(df, "filled", 5, "ma_5", size)
    df = long.centred_average(df, "filled", 252, "trend", size)
    return rounded(df.select("series_id", "ts", "event_id", F.col("_t").alias("t"), "filled", "running", "ma_5", "trend"), ma_5=4, trend=5)


def _prepared(spark, sf, bind=B.orders_binding):
    return features.prepare(bind(spark, sf).panel(), CFG)


def prepared_panel(spark, sf):
    return rounded(_prepared(spark, sf).drop("last_day", features.NOISY), low=6, high=6)


def _frame(spark, sf, variant="full", bind=B.orders_binding):
    return features.feature_frame(_prepared(spark, sf, bind), CFG, variant)


def feature_frame(spark, sf):
    return rounded(_frame(spark, sf), ma_5=4)


def feature_frame_strict(spark, sf):
    return rounded(_frame(spark, sf, "strict"), ma_5=4)


def feature_frame_basic(spark, sf):
    return rounded(_frame(spark, sf, "basic"), ma_5=4)


def status(spark, sf):
    bound = B.orders_binding(spark, sf, unknown=True)
    prepared = features.prepare(bound.panel(), CFG)
    return series_status(bound.areas, prepared, CFG)


# --- statistics, scaling, split -------------------------------------------------


def correlation_matrix(spark, sf, bind=B.orders_binding):
    frame = _frame(spark, sf, bind=bind)
    names = [c for c in numeric_columns(drop_string_columns(frame)) if c != "n_areas"]
    return rounded(stats.correlation_matrix(frame, names))


def selected_correlation(spark, sf):
    """The correlations of each series' selected features and the close."""
    frame = _frame(spark, sf)
    names = features.feature_names(frame, CFG)
    doubles = frame.select("series_id", *[F.col(c).cast("double").alias(c) for c in [*names, "target"]])
    top = stats.rank_features(stats.feature_scores(frame, names), CFG.k_best)
    return rounded(stats.selected_correlation(stats.correlation_matrix(doubles, [*names, "target"]), top))


def feature_f_scores(spark, sf):
    frame = _frame(spark, sf)
    return rounded(stats.feature_scores(frame, features.feature_names(frame, CFG)))


def select_k_best(spark, sf):
    frame = _frame(spark, sf)
    names = features.feature_names(frame, CFG)
    chosen = stats.project_selected(stats.with_selection(frame, names, CFG.k_best), names)
    return rounded(stats.selected_long(chosen, names))


def feature_ranks(spark, sf):
    frame = _frame(spark, sf)
    return rounded(stats.rank_features(stats.feature_scores(frame, features.feature_names(frame, CFG)), CFG.k_best))


def _scale(spark, sf, method, bind=B.orders_binding, settle=True):
    frame = split.train_val_split(_frame(spark, sf, bind=bind), CFG.horizon, CFG.sequence_length)
    names = features.feature_names(frame, CFG)
    scaled = scale.scale_columns(frame, names, method, fit_on=F.col("is_train"), settle=settle)
    out = rounded(scaled.select("series_id", "date", *names), **{c: 6 for c in names})
    return out


def supplier_quartiles(spark, sf):
    """Quartiles of each supplier's closes and volumes, exact."""
    found = exact_quantiles(B.supplier_bars(spark, sf), ["close", "volume"], [0.25, 0.5, 0.75])
    at = lambda k: F.get("quantiles", F.lit(k))
    return rounded(found.select("series_id", "column", "n", at(0).alias("q1"), at(1).alias("median"), at(2).alias("q3")), q1=4, median=4, q3=4)


def inverse_scale(spark, sf):
    df = split.train_val_split(_frame(spark, sf), CFG.horizon, CFG.sequence_length)
    df = scale.scale_columns(df.select("series_id", "date", "target", "is_train"), ["target"], "standard", F.col("is_train"), ["target"])
    back = scale.inverse_scale(F.col("target"), F.col("target_center"), F.col("target_scale"))
    return rounded(df.select("series_id", "date", F.col("target").alias("scaled"), back.alias("restored")), restored=3)


def train_val_split(spark, sf):
    df = split.train_val_split(_frame(spark, sf), CFG.horizon, CFG.sequence_length)
    return df.select("series_id", "date", "t", "n", "train_size", "is_train", "is_val", "is_train_target", "is_val_target")


def _row_sum(row: Column) -> Column:
    """The sum of at most ``k_best`` values, written out so that it stays in generated code."""
    total = F.lit(0.0)
    for i in range(CFG.k_best):
        total = total + F.when(F.size(row) > i, F.get(row, F.lit(i))).otherwise(0.0)
    return total


def _sequences(spark, sf, bind=B.orders_binding):
    frame = _frame(spark, sf, bind=bind)
    return split.sequences(scaled_inputs(frame, CFG), "features", CFG.sequence_length)


def sequence_digest(seqs: DataFrame) -> DataFrame:
    """Per sequence its length, oldest and newest row sums and a position-weighted sum."""
    sums = [_row_sum(F.get("sequence", F.lit(j))) for j in range(CFG.sequence_length)]
    # named twice, each sum is a method of its own: all in one are too long for the JVM to compile
    sums = [F.greatest(s, s) for s in sums]
    weighted = F.lit(0.0)
    for j, total in enumerate(sums):
        weighted = weighted + total * (j + 1)
    return seqs.select(
        "series_id",
        "date",
        F.size("sequence").alias("n_rows"),
        F.size(F.get("sequence", F.lit(0))).alias("n_features"),
        sums[0].alias("oldest"),
        sums[-1].alias("newest"),
        weighted.alias("weighted"),
        F.col("target").alias("target_scaled"),
        "is_val_target",
    )


def sequences(spark, sf):
    return rounded(sequence_digest(_sequences(spark, sf)), weighted=5)


# --- grid search and evaluation ---------------------------------------------------


def _plan(spark, sf, bind=B.orders_binding, reuse=False) -> ForecastPlan:
    return forecast_panel(bind(spark, sf).panel(), CFG, reuse)


def grid_trials(spark, sf):
    trials = grid.expand_families(CFG.grid)
    return grid.trials_per_series(B.order_ticks(spark, sf), trials).drop("params")


def grid_product(spark, sf):
    """Every combination of the networks' parameters, for every series."""
    trials = grid.expand_product(NETWORK_GRID, "rnn_type")
    return grid.trials_per_series(B.order_ticks(spark, sf), trials).drop("params")


def grid_scores(spark, sf):
    return rounded(_plan(spark, sf).scores)


def _inputs(spark, sf, bind=B.orders_binding):
    return stored(scaled_inputs(_frame(spark, sf, bind=bind), CFG), "inputs")


def loss_curves(spark, sf):
    """Loss after each epoch of the trials of the product grid."""
    return rounded(linear.trained_curves(_inputs(spark, sf), CFG))


def best_iteration(spark, sf):
    return rounded(grid.best_iteration(linear.trained_curves(_inputs(spark, sf), CFG)))


def early_stopping(spark, sf):
    return rounded(linear.early_stopping(linear.trained_curves(_inputs(spark, sf), CFG)))


def trained_grid(spark, sf):
    """The trials of ``linear.TRAINED_GRID`` ranked by the loss that early stopping restores."""
    inputs = _inputs(spark, sf)
    return rounded(grid.leaderboard(linear.trained_scores(linear.early_stopping(linear.trained_curves(inputs, CFG)), inputs)), rmse=6)


def ridge_grid(spark, sf, bind=B.orders_binding):
    # read once, so the rows stay in the tasks that made them
    return rounded(grid.leaderboard(linear.ridge_scores(scaled_inputs(_frame(spark, sf, bind=bind), CFG), CFG)), rmse=6)


def joint_leaderboard(spark, sf):
    """Trials of the SQL families, ridge and the trained grid in one ranking."""
    return rounded(forecast_panel(_orders_panel(spark, sf), CFG, learned=True).leaderboard, rmse=6)


def best_per_family(spark, sf):
    return rounded(_plan(spark, sf).best_per_family)


def best_trial(spark, sf):
    return rounded(_plan(spark, sf).best)


def best_forecast(spark, sf):
    best = grid.best_forecast(_plan(spark, sf).predictions)
    return rounded(best.select("series_id", "date", "trial_id", "family", "params_str", "actual", "predicted"), predicted=6)


def grid_leaderboard(spark, sf):
    return rounded(_plan(spark, sf).leaderboard, rmse=6)


def smooth_predictions(spark, sf):
    return rounded(_plan(spark, sf).forecast, actual=3)


def forecast_metrics(spark, sf, bind=B.orders_binding):
    metrics = _plan(spark, sf, bind).metrics
    return rounded(metrics.withColumn("mse", significant(F.col("mse")).cast("string"))).withColumn("mse", F.col("mse").cast("double"))


def forecast_counts(spark, sf):
    plan = _plan(spark, sf, reuse=True)
    targets = split.train_val_split(plan.frame, CFG.horizon, CFG.sequence_length).where("is_val_target")
    return evaluate.forecast_counts(targets, plan.forecast)


def residuals(spark, sf):
    return rounded(_plan(spark, sf).residuals.select("series_id", "date", "residual"))


def residual_histogram(spark, sf):
    return rounded(_plan(spark, sf).residual_histogram)


def forecast_report(spark, sf):
    # the training rows and the forecast both read the feature frame
    return rounded(_plan(spark, sf, reuse=True).report)


# --- learned models (rows only) ----------------------------------------------------


def ml_forecast(spark, sf):
    return ml.pooled_grid(scaled_inputs(_frame(spark, sf), CFG), CFG).forecast


def tree_loss_curves(spark, sf):
    return ml.loss_curves(scaled_inputs(_frame(spark, sf), CFG), CFG)


def learned_leaderboard(spark, sf):
    """The SQL families' and the learned trials of every series in one ranking."""
    frame = stored(_frame(spark, sf), "frame")
    plain = grid.grid_scores(grid.grid_predictions(frame, grid.expand_families(CFG.grid), CFG.horizon, CFG.sequence_length))
    learned = ml.pooled_grid(scaled_inputs(frame, CFG), CFG).scores
    return grid.leaderboard(plain.unionByName(learned.withColumn("trial_id", F.col("trial_id") + len(grid.expand_families(CFG.grid)))))


# --- the same operators on the supplier panel, whose series grow with the data -----


def supplier_bars(spark, sf):
    return rounded(B.supplier_bars(spark, sf), low=6, high=6)


def supplier_combined_panel(spark, sf):
    return rounded(B.supplier_binding(spark, sf).panel(), low=6, high=6)


def supplier_seasonal_decompose(spark, sf):
    bars = B.supplier_bars(spark, sf).select("series_id", "date", "close").repartition(B.supplier_tasks(spark, sf), "series_id")
    return rounded(decompose(P.densify(bars, *B.supplier_days(spark, sf), fill=True).where(F.col("close").isNotNull())))


def supplier_feature_frame(spark, sf):
    return rounded(_frame(spark, sf, bind=B.supplier_binding), ma_5=4, seasonal_adjusted_close=2, random_component=2, ou_simulated=2)


def supplier_f_scores(spark, sf):
    frame = _frame(spark, sf, bind=B.supplier_binding)
    return rounded(stats.feature_scores(frame, features.feature_names(frame, CFG)))


def supplier_correlation_matrix(spark, sf):
    return correlation_matrix(spark, sf, B.supplier_binding)


def supplier_sequences(spark, sf):
    return rounded(sequence_digest(_sequences(spark, sf, B.supplier_binding)), weighted=5)


def supplier_scale_standard(spark, sf):
    # Rows of every series and day are too many to write; a join of the state would drop a series without a name.
    return _scale(spark, sf, "standard", B.supplier_binding, settle=False).where(F.col("series_id").isNotNull())


def supplier_grid_leaderboard(spark, sf):
    return rounded(_plan(spark, sf, B.supplier_binding).leaderboard, rmse=6)


def supplier_forecast_metrics(spark, sf):
    return forecast_metrics(spark, sf, B.supplier_binding)


def supplier_ridge_grid(spark, sf):
    return ridge_grid(spark, sf, B.supplier_binding)


QUERIES: dict[str, Query] = {
    "ohlcv_daily": ohlcv_daily,
    "ohlcv_events": ohlcv_events,
    "load_dated_table": load_dated_table,
    "rejected_cells": rejected_cells,
    "file_layouts": file_layouts,
    "load_layouts": load_layouts,
    "rejected_lines": rejected_lines,
    "restarted_sink": restarted_sink,
    "macro_sink": macro_sink,
    "sink_order": sink_order,
    "combined_sink": combined_sink,
    "results_sink": results_sink,
    "normalize_bars": normalize,
    "calendar_densify": calendar_densify,
    "forward_fill": forward_fill,
    "calendar_columns": calendar,
    "seasonal_features": seasonal_features,
    "macro_filter": macro_filter,
    "macro_period_parse": macro_period_parse,
    "macro_pivot": macro_pivot,
    "macro_for_series": macro_for_series,
    "missing_areas": missing_areas,
    "macro_asof": macro_asof,
    "asof_hot": asof_hot,
    "sdmx_observations": sdmx_observations,
    "combined_panel": combined_panel,
    "incremental_panel": incremental_panel,
    "closing_prices": closing_prices,
    "wide_close": wide_close,
    "last_n_years": last_n_years,
    "lag_features": lag_features,
    "ma5": ma5,
    "seasonal_decompose": seasonal_decompose,
    "decomposition_report": decomposition_report,
    "seasonal_adjusted": seasonal_adjusted,
    "close_moments": close_moments,
    "price_entropy": price_entropy,
    "random_component": random_component,
    "ou_noise": ou_noise,
    "mean_reversion": mean_reversion,
    "long_series": long_series,
    "prepared_panel": prepared_panel,
    "feature_frame": feature_frame,
    "feature_frame_strict": feature_frame_strict,
    "feature_frame_basic": feature_frame_basic,
    "series_status": status,
    "correlation_matrix": correlation_matrix,
    "selected_correlation": selected_correlation,
    "feature_f_scores": feature_f_scores,
    "feature_ranks": feature_ranks,
    "select_k_best": select_k_best,
    "scale_standard": lambda spark, sf: _scale(spark, sf, "standard"),
    "scale_minmax": lambda spark, sf: _scale(spark, sf, "normalize"),
    "scale_robust": lambda spark, sf: _scale(spark, sf, "robust"),
    "inverse_scale": inverse_scale,
    "train_val_split": train_val_split,
    "sequences": sequences,
    "grid_trials": grid_trials,
    "grid_product": grid_product,
    "grid_scores": grid_scores,
    "loss_curves": loss_curves,
    "best_iteration": best_iteration,
    "best_per_family": best_per_family,
    "best_trial": best_trial,
    "best_forecast": best_forecast,
    "grid_leaderboard": grid_leaderboard,
    "smooth_predictions": smooth_predictions,
    "forecast_metrics": forecast_metrics,
    "forecast_counts": forecast_counts,
    "residuals": residuals,
    "residual_histogram": residual_histogram,
    "forecast_report": forecast_report,
    "ml_forecast": ml_forecast,
    "early_stopping": early_stopping,
    "trained_grid": trained_grid,
    "joint_leaderboard": joint_leaderboard,
    "tree_loss_curves": tree_loss_curves,
    "learned_leaderboard": learned_leaderboard,
    "ridge_grid": ridge_grid,
    "supplier_bars": supplier_bars,
    "supplier_combined_panel": supplier_combined_panel,
    "supplier_mean_reversion": supplier_mean_reversion,
    "supplier_quartiles": supplier_quartiles,
    "supplier_seasonal_decompose": supplier_seasonal_decompose,
    "supplier_feature_frame": supplier_feature_frame,
    "supplier_f_scores": supplier_f_scores,
    "supplier_correlation_matrix": supplier_correlation_matrix,
    "supplier_sequences": supplier_sequences,
    "supplier_scale_standard": supplier_scale_standard,
    "supplier_grid_leaderboard": supplier_grid_leaderboard,
    "supplier_forecast_metrics": supplier_forecast_metrics,
    "supplier_ridge_grid": supplier_ridge_grid,
}
