"""Every query against its SQL, and the shape of the plans."""

import duckdb
import pytest

import __spark_entry__ as entry
from panelcast.operators import scale
from panelcast.queries import QUERIES
from tools.check import connect, differences

ORACLES = entry.oracle_sql()
NAMES = list(QUERIES)
ROWS_ONLY = {"ml_forecast", "tree_loss_curves", "learned_leaderboard"}


@pytest.fixture(scope="module")
def con(sf) -> duckdb.DuckDBPyConnection:
    return connect(sf)


def test_every_query_has_sql_unless_it_trains_a_model():
    assert set(NAMES) - set(ORACLES) == ROWS_ONLY and set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ROWS_ONLY])
def test_query_matches_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    problem = differences(df.toPandas(), con.execute(ORACLES[name]).df())
    assert not problem, problem


def test_entry(spark):
    assert entry.entry(spark).count() == 55


def test_one_shuffle_carries_the_panel_to_the_forecast(spark, sf):
    """After the panel is stacked by series nothing is shuffled again."""
    plan = entry.queries()["supplier_forecast_metrics"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    above_union = plan.split("Union")[0]
    assert above_union.count("Exchange hashpartitioning") == 1 and "hashpartitioning(series_id" in above_union


def test_scan_reads_only_what_it_needs(spark, sf):
    plan = entry.queries()["supplier_bars"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    read = plan.split("ReadSchema: ")[1]
    assert "l_discount" not in read and "l_partkey" not in read


def test_hash_aggregation_for_single_key_bars(spark, sf):
    plan = entry.queries()["ohlcv_daily"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_hash_aggregation_for_two_column_orders(spark, sf):
    for name in ("supplier_bars", "ohlcv_events"):
        plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_the_grid_draws_no_noise(spark, sf):
    plan = entry.queries()["supplier_grid_leaderboard"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan


def test_supplier_rows_are_scaled_without_being_written(spark, sf, monkeypatch):
    """A panel of every series and day is far larger than the tables it comes from."""
    def refuse(df):
        raise AssertionError("the rows were written")

    monkeypatch.setattr(scale, "materialize", refuse)
    plan = entry.queries()["supplier_scale_standard"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Union")[0].count("Exchange hashpartitioning") == 1


def test_the_digest_of_sequences_stays_in_generated_code(spark, sf):
    plan = entry.queries()["supplier_sequences"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan
