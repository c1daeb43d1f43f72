"""The first rows of an order equal a plain sort and limit on both sides of the top-n bound."""

import pytest
from pyspark.sql import functions as F

from restock.functions.hashing import hash_text
from restock.operators.metric_documents import metrics_flatten
from restock.operators.ordering import first_rows
from restock.operators.sampling import eval_or_train_sample

ROWS = 1_400


@pytest.fixture(scope="module")
def orders(spark):
    rows = [(i, None if i % 7 == 0 else i % 5, None if i % 3 == 0 else f"t{i % 11}") for i in range(ROWS)]
    return spark.createDataFrame(rows, "id long, number long, word string")


@pytest.mark.parametrize("n", [999, 1000, 1001, 1399, 1400, 2000])
@pytest.mark.parametrize("leading", ["number", "word"])
def test_first_rows_like_sort_and_limit(orders, leading, n):
    expected = orders.orderBy(leading, "id").limit(n)
    assert sorted(r.id for r in first_rows(orders, [leading, "id"], n).collect()) == sorted(r.id for r in expected.collect())


@pytest.mark.parametrize("n", [1001, 1300])
def test_cut_inside_the_nulls(spark, n):
    rows = spark.createDataFrame([(i, None if i < 1_250 else 1) for i in range(ROWS)], "id long, number long")
    assert sorted(r.id for r in first_rows(rows, ["number", "id"], n).collect()) == list(range(n))


def test_hashes_tell_null_places_apart(spark):
    rows = spark.createDataFrame([("1", None, "2"), ("1", "2", None)], "a string, b string, c string")
    assert rows.select(hash_text(1, ["a", "b", "c"])).distinct().count() == 2


def test_documents_of_any_depth(spark):
    text = '{"a": {"b": {"c": {"d": {"e": 1}, "on": false}}}, "a_b_c_on": 7, "x": "no", "y": null, "z": [1]}'
    rows = spark.createDataFrame([(text,), ('{"m": 2}',), ("{}",), (None,)], "value string")
    found = sorted((r.metric_name, r.metric_value) for r in metrics_flatten(rows).collect())
    assert found == [("a_b_c_d_e", 1.0), ("a_b_c_on", 0.0), ("m", 2.0)]


def test_training_rows_stand_in_only_without_eval_rows(spark):
    train = spark.range(50).withColumn("v", F.col("id") * 2)
    assert eval_or_train_sample(train, train.limit(0), ["id"], 1).count() == 50
    assert eval_or_train_sample(train, train.limit(0), ["id"], 1, 20).count() == 20
    assert eval_or_train_sample(train, train.filter("id < 3"), ["id"], 1, 20).count() == 3
