"""A warehouse folder outlives the object that wrote it."""

import pytest
from pyspark.sql import functions as F

from restock.plans.stored import reopened
from restock.plans.warehouse import Warehouse

STAMP = "2024-02-01 00:00:00"


def no_source():
    raise AssertionError("not asked for")


def test_two_objects_on_one_folder_number_models_together(spark, tmp_path):
    first = Warehouse(spark, str(tmp_path / "w"), no_source)
    assert first.dim_model.isEmpty() and first.register_model("a", "1", STAMP) == 1
    second = reopened(first)
    assert second.register_model("b", "1", STAMP) == 2
    assert first.register_model("c", "1", STAMP) == 3
    assert second.register_model("a", "1", STAMP) == 1
    names = {row.model_key: row.model_name for row in reopened(first).dim_model.collect()}
    assert names == {1: "a", 2: "b", 3: "c"}


def test_stored_tables_are_read_and_not_built_again(spark, warehouse, tmp_path):
    first = Warehouse(spark, str(tmp_path / "w"), lambda: warehouse.observations.filter(F.col("dt") < "2024-01-04"))
    counts = {name: df.count() for name, df in first.all_tables().items()}
    assert counts["fact_hourly"] == 24 * counts["fact_daily"] > 0
    again = Warehouse(spark, first.tables.path, no_source)
    assert {name: df.count() for name, df in again.all_tables().items()} == counts
    assert again.decision_scores.count() == first.decision_scores.count()


def test_a_first_write_that_broke_off_is_no_table(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), no_source)
    (tmp_path / "w" / "dim_model" / "_temporary" / "0").mkdir(parents=True)
    assert not w.tables.exists("dim_model") and w.dim_model.isEmpty()
    assert w.register_model("a", "1", STAMP) == 1
    with pytest.raises(AssertionError):
        w.observations  # noqa: B018 - nothing is stored, so the source is asked
