"""Registered queries against independent SQL on the smallest data set."""

import pytest
from compare import connect, difference, spark_rows, sql_rows
from small_data import SMALL

import __spark_entry__
from lanecast.registry.oracles import ORACLES
from lanecast.registry.queries import QUERIES

# One query per family; ``tests/compare.py`` checks all of them at any scale.
CHECKED = (
    "stage_domestic",
    "macro_annual_pivot",
    "zone_to_state",
    "corridor_annual_large_dimension",
    "corridor_history_state",
    "benchmark_band",
    "corridor_enriched",
    "feat_on_sparse_zone_pairs",
    "feat_calendar_windows",
    "table_replaced_whole",
    "retrain_changed",
    "load_flow_csv",
    "corridor_rows",
    "ordered_scan",
    "score_table_ordered",
    "importance_file",
    "feat_infinite_inputs",
    "profile_files",
    "series_replace",
    "macro_extrapolate",
    "future_regressors",
    "step_regressors",
    "forecast_random_walk",
    "forecast_arima_fixed_order",
    "forecast_arima",
    "arima_orders",
    "forecast_trend",
    "backtest_models",
    "interval_quantile",
    "expanding_splits",
    "model_comparison",
    "forecast_store",
    "run_log_flat",
    "kpi_latest_year",
    "chart_feed",
    "profile_missing",
    "profile_duplicates",
    "profile_distinct",
    "profile_numeric_large",
    "profile_categorical",
)
FITTED = {"full_evaluation", "forecast_boosted", "boosted_importance", "boosted_nodes", "top_features"}


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, connection, name):
    got = spark_rows(__spark_entry__.queries()[name](spark, SMALL))
    assert difference(got, sql_rows(connection, __spark_entry__.oracle_sql()[name])) is None
    assert got[1]


def test_every_query_but_the_fitted_models_has_sql():
    assert set(QUERIES) - set(ORACLES) == FITTED and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
