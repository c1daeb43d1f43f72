"""What no plan may contain, and what scans must push down."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from restock.operators import decisions, demand, features, quality
from restock.sources import files
from restock.sources.tables import touched_partitions


def plan(df):
    # Else the names of scanned folders are cut off.
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "4000")
    return df._jdf.queryExecution().executedPlan().toString()


CHECKED = """
feature_scan hourly_demand_estimate decision_scores kpi_by_day queue_diverse hourly_drilldown_day story_readout lags
prepare_features comparison_encode latent_target segment_metrics calibration_factor sample_product_date_stratified
sample_cap_product_date constraint_report prediction_import
""".split()


@pytest.mark.parametrize("name", CHECKED)
def test_no_python_and_no_cross_joins(spark, folder, name):
    text = plan(entry.queries()[name](spark, folder))
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_feature_scan_prunes_dates(warehouse):
    text = plan(files.feature_scan(warehouse.training_features, start=date(2024, 1, 8), end=date(2024, 1, 9)))
    assert re.search(r"PartitionFilters: \[[^\]]*date_key[^\]]*20240108", text)


def test_model_key_prunes_estimates(warehouse):
    text = plan(demand.model_estimates(warehouse.demand_estimates, warehouse.active_model))
    assert re.search(r"PartitionFilters: \[[^\]]*model_key", text)


@pytest.mark.parametrize("name", ["kpi_by_day", "decision_scores", "queue_diverse", "model_quality_latest", "latest_model_with_predictions"])
def test_active_model_opens_no_estimates(spark, folder, name):
    assert "/demand_estimates" not in plan(entry.queries()[name](spark, folder))


def test_upsert_opens_only_touched_partitions(spark, warehouse):
    incoming = warehouse.fact_daily.filter(F.col("date_key") == 20240105)
    text = plan(touched_partitions(warehouse.fact_daily, incoming, ("date_key",)))
    assert re.search(r"PartitionFilters: \[[^\]]*date_key[^\]]*20240105", text) and "20240106" not in text
    incoming = warehouse.demand_estimates.filter((F.col("date_key") == 20240105) & (F.col("model_key") == 2))
    touched = touched_partitions(warehouse.demand_estimates, incoming, ("model_key", "date_key"))
    assert touched.count() == incoming.count() and re.search(r"PartitionFilters: \[[^\]]*model_key", plan(touched))
    both = incoming.unionByName(warehouse.demand_estimates.filter("date_key = 20240106 AND model_key = 1"))
    assert touched_partitions(warehouse.demand_estimates, both, ("model_key", "date_key")).count() == both.count()
    assert touched_partitions(warehouse.fact_daily, incoming.limit(0), ("date_key",)).isEmpty()


def test_features_scan_the_fact_once_and_keep_wide_rows_in_place(spark, folder, warehouse):
    text = plan(features.prepare_features(warehouse.training_features))
    assert len(re.findall(r"Location: [^\[]*\[[^\]]*/fact_hourly\]", text)) == 1
    # The two histories are joined by broadcast; only pair-level roll-ups may shuffle the rows.
    assert not re.search(r"SortMergeJoin \[source_split[^\]]*, (store_id|first_category_id)[^\]]*, date_key", text)


def test_references_of_a_table_take_one_scan(warehouse):
    parents = {key: warehouse.dim_date.select(F.col("date_key").alias(key)) for key in ("date_key", "time_key")}
    for report in quality._reference_rules("fact_hourly", warehouse.fact_hourly, parents):
        assert "/fact_hourly" not in plan(report)


def test_rank_filter_limits_before_the_shuffle(spark, folder):
    assert "WindowGroupLimit" in plan(entry.queries()["rank_per_action"](spark, folder))


def test_narrow_queries_read_narrow_columns(warehouse):
    text = plan(decisions.product_average(warehouse.fact_daily))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert schema == "product_key:int,observed_daily_sales_amount:double"
