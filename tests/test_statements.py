"""Queries against their SQL statements. RESTOCK_ALL=1 runs every one of them."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, connect

SELECTED = """
observations_from_files prediction_import prediction_import_full metrics_flatten queue_csv sample_even
sample_product_date_stratified panel_select sample_cap_product_date dim_date dim_model_upsert fact_daily upsert
upsert_columns upsert_conflicts kpi_by_day kpi_by_day_unmodelled what_if action_lanes model_quality_latest hour_ranges
weighted_median queue_diverse data_quality_checks failed_checks constraint_report_broken recommendations decision_scores
hourly_drilldown_day story_readout latest_model_with_predictions store_traffic_lag_1h comparison_baselines
calibration_factor segment_metrics evaluation_rows
""".split()


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


def test_every_statement_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("RESTOCK_ALL") else SELECTED)
def test_query_agrees_with_its_statement(spark, connection, folder, name):
    assert compare(entry.queries()[name](spark, folder), connection, entry.oracle_sql()[name]) is None
