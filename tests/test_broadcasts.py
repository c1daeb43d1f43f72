"""Joins of tables that grow with the facts: files of less than a byte a row must not pass as small."""

import re

import pytest

import __spark_entry__ as entry
from restock import fixtures
from restock import schema as S
from restock.operators import comparison, features, merge
from test_plans import plan


def of_pairs(text):
    """Hash joins by broadcast whose keys name a store and a product: one side has a row per pair at least."""
    keys = re.findall(r"BroadcastHashJoin \[([^\]]*)\]", text)
    return [found for found in keys if re.search("store_(key|id)", found) and re.search("product_(key|id)", found)]


def test_scored_rows_are_not_broadcast(warehouse):
    assert not of_pairs(plan(warehouse._score(2, "eval")))


@pytest.mark.parametrize("key", [1, 2])
def test_train_rows_of_both_models_are_not_broadcast(warehouse, key):
    assert not of_pairs(plan(warehouse._score(key, "train")))


def test_observations_spread_their_days(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    assert not of_pairs(plan(fixtures.observations_from_events(events)))


@pytest.mark.parametrize("name", ["hourly_demand_estimate", "hourly_drilldown", "recommendations", "decision_scores",
    "latent_target", "prepare_features", "demand_priors", "stockout_priors", "panel_apply", "story_readout"])
def test_facts_and_roll_ups_are_not_broadcast(spark, folder, name):
    assert not of_pairs(plan(entry.queries()[name](spark, folder)))


def test_upserts_do_not_broadcast_the_fact(warehouse):
    rows = warehouse.fact_daily
    keys = ["date_key", "store_key", "product_key"]
    assert not of_pairs(plan(merge.upsert(rows, rows, keys)))
    assert not of_pairs(plan(merge.upsert(rows, rows, keys, update=["discount_rate"])))


def test_a_long_history_is_not_broadcast(spark, warehouse, monkeypatch):
    monkeypatch.setattr(features, "HISTORY_ROWS", 10)
    text = plan(features.store_traffic(warehouse.training_features))
    assert not re.search(r"BroadcastHashJoin \[source_split", text)


def test_days_of_a_longer_history_are_broadcast(warehouse, monkeypatch):
    """With the hours of a day in one row five times the history is sent to the tasks, and nothing is shuffled by store."""
    rows = warehouse.training_features
    names = [*S.HOURLY_KEY, "store_traffic_lag_1h"]
    whole = features.store_traffic(rows).select(*names)
    monkeypatch.setattr(features, "HISTORY_ROWS", features.store_history(rows).count() - 1)
    found = features.store_traffic(rows).select(*names)
    assert re.search(r"BroadcastHashJoin \[source_split", plan(found))
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()


def test_wide_rows_are_shuffled_once(warehouse):
    rows = features.prepare_features(warehouse.training_features)
    shuffled = [line for line in plan(rows).splitlines() if "Exchange hashpartitioning" in line]
    # The other one is that of the pairs with their priors.
    assert sum("REPARTITION_BY_COL" in line for line in shuffled) == 1 and len(shuffled) == 2


def test_comparison_rows_are_shuffled_once(warehouse):
    rows = comparison.latent_target(comparison.comparison_context(comparison.comparison_hourly(warehouse.observations)))
    shuffled = [line for line in plan(rows).splitlines() if "Exchange hashpartitioning(store_id" in line]
    assert sum("REPARTITION_BY_COL" in line for line in shuffled) == 1
    # The other one is that of the baselines.
    assert len(shuffled) == 2
