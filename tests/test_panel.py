from datetime import date, datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.functions.dates import calendar_columns
from panelcast.operators import features, macro
from panelcast.operators.clean import normalize_bars
from panelcast.operators.combine import combine
from panelcast.operators.panel import asof_join, densify, forward_fill, to_wide
from panelcast.plans import tables
from panelcast.schema import MissingColumns, drop_string_columns, numeric_columns, require_columns
from panelcast.sources.ticks import resample_bars
from tests.helpers import closes, column, days

OBS = [("s", date(2019, 12, 31), 9.0), ("s", date(2020, 1, 2), 10.0), ("s", date(2020, 1, 3), None), ("s", date(2020, 1, 6), 13.0)]
RANGE = ("2020-01-01", "2020-01-08")


def test_densify_and_fill_agree_with_the_two_step_form(spark):
    df = closes(spark, OBS)
    want = [None, 10, 10, 10, 10, 13, 13, 13]
    assert column(densify(df, *RANGE, fill=True), "close") == want
    assert column(forward_fill(densify(df, *RANGE)), "close") == want
    assert column(densify(df, *RANGE), "close") == [None, 10, None, None, None, 13, None, None]


def test_densify_matches_pandas_on_random_gaps(spark):
    rng = np.random.default_rng(1)
    frames, rows = {}, []
    for s in ("a", "b", "c"):
        picked = np.sort(rng.choice(400, 150, replace=False))
        values = np.where(rng.random(150) < 0.2, np.nan, rng.random(150))
        index = pd.Timestamp("2020-01-01") + pd.to_timedelta(picked, unit="D")
        frames[s] = pd.Series(values, index=index)
        rows += [(s, d.date(), None if np.isnan(v) else float(v)) for d, v in frames[s].items()]
    got = densify(closes(spark, rows), "2020-01-20", "2021-01-10", fill=True).toPandas()
    calendar = pd.date_range("2020-01-20", "2021-01-10")
    for s, series in frames.items():
        want = series.reindex(calendar).ffill().to_numpy()
        mine = got[got.series_id == s].sort_values("date").close.to_numpy(dtype=float)
        np.testing.assert_array_equal(mine, want)


def test_duplicate_days_raise_and_name_the_key(spark):
    df = closes(spark, [("dup", date(2020, 1, 2), 1.0), ("dup", date(2020, 1, 2), 2.0)])
    with pytest.raises(Exception, match="duplicate row for dup 2020-01-02"):
        densify(df, *RANGE, fill=True).collect()


def test_a_row_without_date_keeps_its_series(spark):
    df = closes(spark, [("empty", None, None), ("s", date(2020, 1, 2), 1.0)])
    out = densify(df, "2020-01-01", "2020-01-03", fill=True)
    assert column(out, "close", "empty") == [None, None, None]
    assert column(out, "close", "s") == [None, 1.0, 1.0]


def test_the_calendar_follows_the_rows_and_keeps_every_series(spark):
    df = closes(spark, [("s", date(2020, 1, 2), 1.0), ("late", date(2020, 1, 4), 2.0)])
    assert column(densify(df, fill=True), "close", "s") == [1.0, 1.0, 1.0]
    assert column(densify(df, fill=True), "close", "late") == [None, None, 2.0]
    cut = densify(df, "2020-01-01", "2020-01-02", fill=True)  # nothing of the later series is inside
    assert column(cut, "close", "late") == [None, None] and column(cut, "close", "s") == [None, 1.0]


def test_asof_carries_the_last_value_on_and_refuses_ties(spark):
    left = spark.createDataFrame([(date(2021, 6, 1), "A"), (date(1990, 1, 1), "A")], "date date, area string")
    obs = _obs(spark, [(date(2020, 1, 1), "A", 1.0)])
    for settle in (False, True):
        assert {r.date.year: r.value for r in asof_join(left, obs, ["area"], ["value"], settle=settle).collect()} == {2021: 1.0, 1990: None}
    with pytest.raises(Exception, match="two right rows for A 2020-01-01"):
        asof_join(left, obs.unionByName(obs), ["area"], ["value"]).collect()


def test_any_number_of_areas(spark):
    mapping = macro.with_base_area(macro.area_map(spark, {"x": ["B", "C", "D"], "y": ["A"]}), "A", spark.createDataFrame([("x",), ("new",)], "series_id string"))
    obs = _obs(spark, [(date(2020, 1, 1), a, float(i)) for i, a in enumerate("ABCD")])
    rows = {r.series_id: r for r in macro.series_macro(mapping, obs).collect()}
    assert [rows["x"][f"macro_{i}"] for i in range(4)] == [0.0, 1.0, 2.0, 3.0] and rows["x"].n_areas == 4
    assert rows["new"].macro_0 == 0.0 and rows["new"].n_areas == 1
    bars = closes(spark, days([5.0, 6.0], "x"), days([1.0, 2.0], "new")).withColumn("volume", F.lit(1.0))
    panels = [sorted(combine(bars, m(mapping, obs)).collect(), key=str) for m in (macro.series_macro, macro.routed_macro)]
    assert panels[0] == panels[1] and {r.macro_3 for r in panels[0] if r.series_id == "x"} == {3.0}
    with pytest.raises(Exception, match="more areas than columns"):
        macro.series_macro(mapping, obs, 2).collect()


def test_value_lists_follow_the_data(spark):
    rows = to_wide(closes(spark, days([1.0], "a"), days([3.0], "zz")))
    assert rows.columns == ["date", "close_a", "close_zz"]
    assert macro.pivot_areas(_obs(spark, [(date(2020, 1, 1), "New One", 1.0)])).columns[3:] == ["macro_New_One"]


@pytest.mark.parametrize("interval, starts", [("1wk", ["2019-12-30", "2020-01-27"]), ("1mo", ["2020-01-01", "2020-02-01"]), ("3mo", ["2020-01-01"]), ("5d", ["2020-01-01", "2020-01-31"])])
def test_long_intervals(spark, interval, starts):
    ticks = spark.createDataFrame([("s", d, 1.0, 1, i) for i, d in enumerate(("2020-01-01", "2020-02-02"))], "series_id string, t string, price double, volume int, i long")
    bars = resample_bars(ticks.withColumn("ts", F.col("t").cast("timestamp")), ["i"], interval)
    assert sorted(str(r.date) for r in bars.collect()) == starts
    with pytest.raises(ValueError):
        resample_bars(ticks.withColumn("ts", F.col("t").cast("timestamp")), ["i"], "1y")


def test_two_column_orders_pack_like_they_sort(spark):
    rows = [("s", 5, -3, 1.0), ("s", 5, 2**62, 2.0), ("s", 4, 9, 3.0), ("s", 6, -(2**62), 4.0), ("t", -1, 0, 5.0), ("t", -2, 7, 6.0)]
    ticks = spark.createDataFrame(rows, "series_id string, a long, b long, price double").withColumns({"ts": F.lit("2020-01-01").cast("timestamp"), "volume": F.lit(1)})
    assert {r.series_id: (r.open, r.close) for r in resample_bars(ticks, ["a", "b"]).collect()} == {"s": (3.0, 4.0), "t": (6.0, 5.0)}
    with pytest.raises(Exception):
        resample_bars(ticks.withColumn("a", F.lit(2**63 - 1)), ["a", "b"]).collect()


def test_bars_survive_a_series_with_most_of_the_ticks(spark):
    ticks = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("series_id"),
        F.timestamp_seconds(F.lit(1577836800) + F.col("id") * 7).alias("ts"),
        ((F.col("id") * 7919) % 1000).cast("double").alias("price"),
        F.lit(1).alias("volume"),
        F.col("id"),
    )
    got = resample_bars(ticks, ["id"]).toPandas().sort_values(["series_id", "date"], ignore_index=True)
    raw = ticks.toPandas().sort_values("id")
    raw["date"] = raw.ts.dt.date
    want = raw.groupby(["series_id", "date"]).price.agg(open="first", high="max", low="min", close="last").reset_index()
    want["volume"] = raw.groupby(["series_id", "date"]).volume.sum().to_numpy(dtype=float)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
    by_struct = resample_bars(ticks, ["ts", "id"]).toPandas().sort_values(["series_id", "date"], ignore_index=True)
    pd.testing.assert_frame_equal(got, by_struct)


def test_other_bar_intervals(spark):
    ticks = spark.createDataFrame(
        [("s", "2024-01-01 00:10:00", 1.0, 1, 1), ("s", "2024-01-01 00:50:00", 3.0, 1, 2), ("s", "2024-01-01 01:00:00", 2.0, 1, 3)],
        "series_id string, ts string, price double, volume int, id long",
    ).withColumn("ts", F.to_timestamp("ts"))
    rows = resample_bars(ticks, ["id"], "1h").orderBy("date").collect()
    assert [(r.open, r.high, r.low, r.close, r.volume) for r in rows] == [(1, 3, 1, 3, 2), (2, 2, 2, 2, 1)]


def test_calendar_columns(spark):
    row = calendar_columns(closes(spark, [("s", date(2024, 1, 1), 1.0)])).withColumn("dow", F.weekday("date")).first()
    assert (row.year, row.month, row.quarter, row.day_name, row.dow) == (2024, 1, 1, "Monday", 0)


def test_last_n_years_clamps_leap_days(spark):
    rows = [("s", d, 1.0) for d in (date(2018, 2, 27), date(2018, 2, 28), date(2020, 5, 1), date(2024, 2, 29))]
    assert column(features.last_n_years(closes(spark, rows), 6), "date") == [date(2018, 2, 28), date(2020, 5, 1), date(2024, 2, 29)]


def test_moving_average_needs_five_values(spark):
    df = closes(spark, days([1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 8.0]))
    assert column(features.moving_average(df, 5), "ma_5") == [None] * 7 + [6.0]


def test_lags(spark):
    df = features.lag_features(closes(spark, days([1.0, 2.0, 3.0])), [1, 2])
    assert column(df, "close_lag_1") == [None, 1, 2] and column(df, "close_lag_2") == [None, None, 1]


def test_periods(spark):
    raw = spark.createDataFrame([(p,) for p in ["2010-Q1", "2010-Q4", "2010", "2010-QX", "", "2010-Q5"]], "period string")
    rows = macro.parse_periods(raw).collect()
    assert [r.date for r in rows] == [date(2010, 1, 1), date(2010, 10, 1), None, None, None, None]
    assert sum(r.rejected for r in rows) == 4


def test_macro_values(spark):
    raw = spark.createDataFrame(
        [("2010-Q1", "A", ""), ("2010-Q1", "B", "0"), ("2010-Q1", "C", "NaN"), ("2010-Q1", "D", "x"), (None, "E", "1"), ("2010-Q1", "", "1")],
        "period string, area string, value string",
    )
    assert {r.area: r.value for r in macro.parse_macro(raw).collect()} == {"B": 0.0, "C": None}


def _obs(spark, rows):
    return spark.createDataFrame([(d, d.year, (d.month + 2) // 3, a, v) for d, a, v in rows], "date date, year int, quarter int, area string, value double")


def test_pivot_averages_duplicates(spark):
    d1, d2 = date(2020, 1, 1), date(2020, 4, 1)
    obs = _obs(spark, [(d1, "B", 1.0), (d1, "A", 2.0), (d1, "A", 4.0), (d2, "B", 3.0)])
    rows = macro.pivot_areas(obs, ["B", "A"]).orderBy("date").collect()
    assert [(r.macro_A, r.macro_B) for r in rows] == [(3.0, 1.0), (None, 3.0)]


def test_asof_join(spark):
    obs = _obs(spark, [(date(2020, 1, 1), "A", 1.0), (date(2020, 4, 1), "A", 2.0)])
    left = spark.createDataFrame([(d, "A") for d in (date(2019, 12, 31), date(2020, 3, 31), date(2020, 4, 1))] + [(date(2020, 4, 1), "Z")], "date date, area string")
    out = asof_join(left, obs, ["area"], ["value"]).orderBy("area", "date").collect()
    assert [r.value for r in out] == [None, 1.0, 2.0, None]
    late = asof_join(left, obs, ["area"], ["value"], lag_days=1).orderBy("area", "date").collect()
    assert [r.value for r in late] == [None, 1.0, 1.0, None]


def test_asof_join_against_pandas(spark):
    rng = np.random.default_rng(3)
    stamp = lambda n: [date.fromordinal(737000 + int(i)) for i in n]
    left = pd.DataFrame({"date": stamp(rng.integers(0, 900, 2000)), "k": rng.choice(list("abb"), 2000), "i": range(2000)})
    right = pd.DataFrame({"date": stamp(rng.choice(900, 40, replace=False)), "k": "b", "v": rng.random(40)})
    got = asof_join(spark.createDataFrame(left), spark.createDataFrame(right), ["k"], ["v"], bucket_days=30).toPandas().sort_values("i")
    t = lambda d: d.assign(date=pd.to_datetime(d.date)).sort_values("date")
    want = pd.merge_asof(t(left), t(right), on="date", by="k").sort_values("i")
    np.testing.assert_array_equal(got.v.to_numpy(float), want.v.to_numpy(float))


def test_base_area_and_missing_areas(spark):
    mapping = macro.with_base_area(macro.area_map(spark, {"x": ["B"], "y": ["A"], "z": ["ZZZ"]}), "A")
    assert {(r.series_id, r.pos): r.area for r in mapping.collect()} == {("x", 0): "A", ("x", 1): "B", ("y", 0): "A", ("z", 0): "A", ("z", 1): "ZZZ"}
    obs = _obs(spark, [(date(2020, 1, 1), "A", 1.0), (date(2020, 1, 1), "B", 2.0)])
    assert [tuple(r) for r in macro.missing_areas(mapping, obs).collect()] == [("z", "ZZZ", 1)]
    daily = macro.macro_for_series(mapping, obs, 2, "2019-12-31", "2020-01-02").where("series_id = 'z'").orderBy("date").collect()
    assert [(r.macro_0, r.macro_1) for r in daily] == [(None, None), (1.0, None), (1.0, None)]


def test_combine_equals_separate_fills_and_join(spark):
    bars = closes(spark, OBS, days([5.0, 6.0], "t"), days([1.0], "no_map")).withColumn("volume", F.lit(1.0))
    mapping = macro.with_base_area(macro.area_map(spark, {"s": ["B"], "t": ["A"], "no_bars": ["B"]}), "A")
    obs = _obs(spark, [(date(2019, 10, 1), "A", 7.0), (date(2020, 1, 3), "A", 1.0), (date(2020, 1, 2), "B", 2.0)])
    got = combine(bars, macro.series_macro(mapping, obs, 2), *RANGE)
    assert {r.series_id for r in got.select("series_id").distinct().collect()} == {"s", "t"}
    left = densify(bars, *RANGE, fill=True)
    right = macro.macro_for_series(mapping, obs, 2, *RANGE).drop("obs_year", "obs_quarter")
    names = ["series_id", "date", "close", "volume", "macro_0", "macro_1"]
    want = left.join(right, ["series_id", "date"]).select(names).orderBy("series_id", "date").collect()
    assert got.select(names).orderBy("series_id", "date").collect() == want
    assert column(got, "macro_0", "s") == [None, None, 1, 1, 1, 1, 1, 1]
    assert set(column(got, "n_areas", "s")) == {2} and set(column(got, "n_areas", "t")) == {1}


def test_wide_form(spark):
    rows = to_wide(closes(spark, days([1.0, 2.0], "a"), days([3.0], "b")), ["a", "b"]).orderBy("date").collect()
    assert [(r.close_a, r.close_b) for r in rows] == [(1.0, 3.0), (2.0, None)]


def test_normalize_bars(spark):
    raw = spark.createDataFrame(
        [(None, "AAA", 1.0, 2.0, 0.0), ("Ticker AAA", "AAA", 1.0, 2.0, 0.0), ("soon", "AAA", 1.0, 2.0, 0.0), ("2024-01-01 00:00:00", "AAA", 1.0, 2.0, 0.0)],
        "Datetime string, series_id string, `Adj Close_AAA` double, Close_AAA double, Dividends double",
    )
    out = normalize_bars(raw, add_day_name=True)
    assert out.columns == ["series_id", "date", "year", "month", "day_name", "close", "adj_close"]
    assert [tuple(r) for r in out.collect()] == [("AAA", "2024-01-01", 2024, 1, "Monday", 2.0, 1.0)]
    assert normalize_bars(raw.withColumn("series_id", F.lit("2024|AAA")), regex=True).count() == 0
    assert normalize_bars(raw.withColumn("series_id", F.lit(None).cast("string"))).count() == 1
    with pytest.raises(ValueError, match="Close_AAA.*Close_B"):
        normalize_bars(raw.withColumn("Close_B", F.lit(1.0)))


def test_column_checks(spark):
    df = closes(spark, OBS)
    with pytest.raises(MissingColumns) as e:
        require_columns(df, ["close", "open"])
    assert e.value.missing == ["open"]
    assert numeric_columns(df) == ["close"]
    assert drop_string_columns(df, keep=()).columns == ["date", "close"]


def test_tasks_are_counted_by_the_days_of_the_panel(spark, monkeypatch):
    ticks = spark.createDataFrame([(s, datetime(2020, m, 9 if m == 4 else 1)) for s in "abc" for m in (1, 4)], "series_id string, ts timestamp_ntz")
    assert tables.panel_tasks(ticks) == spark.sparkContext.defaultParallelism  # 300 days, 6 ticks
    monkeypatch.setattr(tables, "TASK_ROWS", 10)
    assert tables.panel_tasks(ticks) == 30
    assert tables.panel_tasks(ticks.limit(0)) == spark.sparkContext.defaultParallelism


def test_the_panel_is_shuffled_into_the_given_tasks(spark):
    bars = closes(spark, days([1.0, 2.0], "a"), days([3.0], "b"))
    rows = spark.createDataFrame([("a", date(2020, 1, 1), 1.0, 1), ("b", date(2020, 1, 1), 2.0, 1)], "series_id string, date date, macro_0 double, n_areas int")
    plain, dealt = combine(bars, rows.withColumn("pos", F.lit(0))), combine(bars, rows.withColumn("pos", F.lit(0)), tasks=37)
    assert "hashpartitioning(series_id" in (plan := dealt._jdf.queryExecution().executedPlan().toString()) and ", 37), REPARTITION_BY_NUM" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert sorted(plain.collect()) == sorted(dealt.collect())
