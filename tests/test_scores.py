"""Golden values of the daily scores and small text functions."""

import pytest
from pyspark.sql import functions as F

from restock import schema as S
from restock.functions import scores
from restock.functions.hours import hour_ranges
from restock.functions.text import amount, percent, percent_label, precise
from restock.plans.catalog import published


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "rate, bias, activity, expected, action",
    [
        (0.625, 0.693, 1, 0.6863, S.RESTOCK),
        (1.0, 1.0, 1, 1.0, S.RESTOCK),
        (0.25, 0.0, 0, 0.1375, S.INCREASE),
        (0.0, 0.25, 0, 0.0875, S.REVIEW),
        (0.0, 0.0, 0, 0.0, S.MAINTAIN),
    ],
)
def test_urgency_and_action(spark, rate, bias, activity, expected, action):
    urgency = scores.urgency(F.lit(rate), F.lit(bias), F.lit(activity))
    assert value(spark, urgency) == pytest.approx(expected, abs=5e-5)
    assert value(spark, scores.decision_action(urgency, F.lit(rate), F.lit(0.0), F.lit(bias))) == action


@pytest.mark.parametrize(
    "stockout, sales, usual, expected",
    [(True, 0.0, 5.0, 0.0), (False, 0.0, 4.0, 1.0), (False, 5.0, 4.0, 0.0), (False, 2.5, 4.0, 0.5), (False, 0.0, 0.0, 1.0), (False, 1.0, 0.0, 0.0)],
)
def test_waste_risk(spark, stockout, sales, usual, expected):
    assert value(spark, scores.waste_risk(F.lit(stockout), F.lit(sales), F.lit(usual))) == pytest.approx(expected)


@pytest.mark.parametrize("hours, text", [([], "none"), ([12], "12:00"), ([6, 7, 8, 9, 12], "6:00-9:00, 12:00"), ([0, 2, 3], "0:00, 2:00-3:00")])
def test_hour_ranges(spark, hours, text):
    array = F.array(*[F.lit(h) for h in hours]) if hours else F.array().cast("array<int>")
    assert value(spark, hour_ranges(array)) == text


def test_number_texts(spark):
    assert value(spark, amount(F.lit(1234.5))) == "1,234.50"
    assert value(spark, amount(F.lit(None).cast("double"))) == "0"
    assert value(spark, precise(F.lit(None).cast("double"))) == "n/a"
    assert value(spark, precise(F.lit(0.92104))) == "0.9210"
    assert value(spark, percent(F.lit(-0.0696))) == "-6.96%"
    assert value(spark, percent_label(F.lit(1.7))) == "100%"


@pytest.mark.parametrize("hours, label", [(16, "critical"), (8, "critical"), (7, "high"), (3, "high"), (1, "watch"), (0, "normal")])
def test_priority(spark, hours, label):
    assert value(spark, scores.restock_priority(F.lit(hours))) == label


def test_published_rounds_like_round(spark):
    """Odd values, ties and both signs come out as ``round`` gives them, to the last bit and without its decimal text."""
    values = [None, 0.0, -0.0, float("nan"), float("inf"), -float("inf"), 1e5, -1e5, 1e300, -1e-300, -4e-7, -5e-7, 99999.9999995]
    values += [sign * k * step for sign in (1, -1) for step in (5e-7, 0.125, 0.37, 1234.5678915) for k in range(200)]
    rows = spark.createDataFrame([(value,) for value in values], "v double")
    usual = F.round(F.col("v") + 1e-9, 6).cast("string")
    both = published(rows.withColumn("usual", usual)).withColumn("own", F.col("v").cast("string"))
    assert both.filter(~F.col("own").eqNullSafe(F.col("usual"))).collect() == []
    assert "floor" in published(rows)._jdf.queryExecution().optimizedPlan().toString().lower()
