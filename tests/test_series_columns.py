"""Operators that take the columns of a whole series at once, against the plain aggregates and windows."""

from math import inf, nan

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelcast import queries
from panelcast.functions.moments import f_score, pair_f_score, pair_moments, pearson_matrix, present
from panelcast.operators import scale, split, stats
from panelcast.operators.scale import scaler_state
from tests.helpers import DAY0, days

COLUMNS = [
    [1.0, 2.0, 4.0, 8.5, 3.0, 2.5],
    [0.1, 0.1, 0.1, 0.1, 0.1, 0.1],
    [None, 5.0, None, 1.0, 2.0, 7.0],
    [None] * 6,
    [None, None, None, None, 3.0, None],
    [1e3 + 1, 1e3 + 3, 1e3, 1e3 + 2, 1e3, 1e3 + 5],
    [1.0, nan, 2.0, 3.0, 1.0, 0.0],
    [1.0, inf, 2.0, 3.0, 1.0, 0.0],
]
NAMES = [f"c{i}" for i in range(len(COLUMNS))]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(s, day, *(c[i] for c in COLUMNS), i < 4) for s in ("s", None) for i, (_, day, _) in enumerate(days(range(6)))]
    return spark.createDataFrame(rows, "series_id string, date date, " + ", ".join(f"{n} double" for n in NAMES) + ", is_train boolean")


def near(a, b):
    return (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9, nan_ok=True))


def test_f_scores_are_those_of_the_aggregates(frame):
    held = [present(pa.array(c, pa.float64())) for c in COLUMNS]
    pairs = [(i, j) for i in range(len(COLUMNS)) for j in range(6)]
    sums = [F.struct(*pair_moments(F.col(NAMES[i]), F.col(NAMES[j]))).alias(f"m{i}_{j}") for i, j in pairs]
    row = frame.where("series_id = 's'").agg(*sums).select(*[f_score(F.col(f"m{i}_{j}")).alias(f"m{i}_{j}") for i, j in pairs]).first()
    for i, j in pairs:
        if i != j and i < 6:
            assert near(pair_f_score(held[i], held[j]), row[f"m{i}_{j}"]), (i, j)


@pytest.mark.parametrize("fit_on", ["all", "train"])
def test_standard_state_is_that_of_the_windows(frame, fit_on):
    on = F.col("is_train") if fit_on == "train" else None
    names = [f"{c}_{s}" for c in NAMES[:7] for s in ("center", "scale")]
    old = frame.withColumns(scaler_state(NAMES[:7], "standard", on)).select(*names).collect()
    new = scale.with_state(frame, NAMES[:7], "standard", on).select(*names).collect()
    assert all(near(a[n], b[n]) for a, b in zip(old, new, strict=True) for n in names)
    plan = scale.with_state(frame, NAMES[:7], "standard", on)._jdf.queryExecution().executedPlan().toString()
    assert "avg(" not in plan and plan.count("Exchange") == 1  # one pass for all columns, and no further shuffle


def test_pairs_with_missing_and_endless_values():
    for k in (6, 8):
        found = np.array(pearson_matrix([present(pa.array(c, pa.float64())) for c in COLUMNS[:k]]), object).reshape(k, k)
        for i in range(6):
            for j in range(6):
                both = [(a, b) for a, b in zip(COLUMNS[i], COLUMNS[j], strict=True) if a is not None and b is not None]
                x, y = (np.array(v) for v in zip(*both, strict=True)) if both else ([], [])
                varies = len(both) > 1 and np.ptp(x) > 0 and np.ptp(y) > 0
                assert near(found[i, j], np.corrcoef(x, y)[0, 1] if varies else None), (i, j)


def test_correlations_list_every_pair_once_without_lists_of_rows(frame):
    found = stats.correlation_matrix(frame, NAMES[:6])
    rows = found.collect()
    assert {(r["series_id"], r["a"], r["b"]) for r in rows} == {(s, a, b) for s in ("s", None) for a in NAMES[:6] for b in NAMES[:6]} and len(rows) == 72
    assert "Generate inline" not in found._jdf.queryExecution().executedPlan().toString()


def test_selection_and_projection_with_and_without_a_bound(frame):
    # equal scores: the later column first
    twice = frame.where("series_id = 's'").select("series_id", "date", "c0", "c2", F.col("c2").alias("c3"), "c4", F.col("c5").alias("target"))
    chosen = stats.with_selection(twice, ["c0", "c2", "c3"], 2)
    assert {tuple(r["selected"]) for r in chosen.select("selected").collect()} == {(1, 2)}
    plain, bounded = (stats.project_selected(chosen, ["c0", "c2", "c3"], ["target"], most).collect() for most in (None, 2))
    assert plain == bounded
    few = stats.with_selection(twice, ["c0", "c4"], 2).withColumn("selected", F.slice("selected", 1, 1))
    assert stats.project_selected(few, ["c0", "c4"]).collect() == stats.project_selected(few, ["c0", "c4"], (), 2).collect()


def test_sequences_are_shifts_and_their_rows_are_added(spark):
    rows = [("a", DAY0.replace(day=k), [float(k), 0.5]) for k in range(1, 7)] + [("b", DAY0.replace(day=k), None if k == 2 else [None, 1.0] if k == 4 else []) for k in range(1, 7)]
    found = split.sequences(spark.createDataFrame(rows, "series_id string, date date, features array<double>"), length=2)
    assert "collect_list" not in found._jdf.queryExecution().executedPlan().toString()
    sums = found.withColumn("s", F.array(*[queries._row_sum(F.get("sequence", F.lit(j))) for j in range(2)])).orderBy("series_id", "date").collect()
    assert [(r["series_id"], r["date"].day, r["sequence"], r["s"]) for r in sums] == [
        ("a", k, [[k - 2.0, 0.5], [k - 1.0, 0.5]], [k - 1.5, k - 0.5]) for k in range(3, 7)
    ] + [("b", 5, [[], [None, 1.0]], [0.0, None]), ("b", 6, [[None, 1.0], []], [None, 0.0])]


def test_ridge_trials_write_no_rows(spark, sf, monkeypatch):
    def written(*_):
        raise AssertionError("rows are written")

    monkeypatch.setattr(queries, "stored", written)
    found = queries.ridge_grid(spark, sf)
    assert {r["rank"] for r in found.collect()} == {1, 2, 3, 4}
