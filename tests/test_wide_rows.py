"""Rows of many columns: no stage may run as one method that the JVM leaves interpreted, and scoring reads few columns."""

import re

from pyspark.sql import functions as F

from restock.operators.boosting import Boosted, BoostingOptions
from restock.operators.learning import DemandModel
from restock.session import prepare
from test_plans import plan


def test_methods_too_long_to_compile_are_not_generated(spark):
    assert int(prepare(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_scoring_reads_only_inputs_and_what_is_asked_for(spark, tmp_path):
    rows = spark.range(4).select("id", F.col("id").cast("double").alias("x"), *[F.lit(1.0).alias(f"other{i}") for i in range(40)])
    rows.write.parquet(f"{tmp_path}/rows")
    stage = Boosted(BoostingOptions(objective="squared"), ["x"], [[]], 2.5)
    model = DemandModel("direct", ["x", "missing"], {"regressor": stage})
    stage.columns, stage.cuts = ["x", "missing"], [[], []]
    scored = model.predict(spark.read.parquet(f"{tmp_path}/rows"))
    assert scored.columns == [*rows.columns, "prediction"]
    few = scored.select("id", "prediction")
    assert re.search(r"ReadSchema: struct<([^>]*)>", plan(few)).group(1) == "id:bigint,x:double"
    assert {(row.id, row.prediction) for row in few.collect()} == {(i, 2.5) for i in range(4)}
