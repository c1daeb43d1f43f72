"""A task reads few files of a fact, so its rows do not grow with the fact."""

import pytest
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", ["fact_hourly", "demand_estimates"])
def test_files_of_a_task(warehouse, name):
    files = getattr(warehouse, name).select(F.spark_partition_id().alias("task"), F.input_file_name().alias("file")).distinct()
    assert files.select("file").distinct().count() > 20
    assert files.groupBy("task").count().agg(F.max("count")).first()[0] <= 2
