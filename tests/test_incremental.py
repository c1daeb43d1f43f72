"""Sums by period follow a reload of their dates only; lags of new dates need a state, not the history."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from restock import schema as S
from restock.operators import demand, features, hour_sums
from restock.operators.boundary import PAIR, ROWS, Boundary
from restock.plans.stored import reopened
from restock.plans.warehouse import Warehouse


def no_source():
    raise AssertionError("everything is stored")


@pytest.fixture(scope="module")
def loaded(spark, warehouse, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("sums")), no_source)
    w.load(warehouse.observations.filter("store_id < 4"))
    w.load_hourly()
    return w


def files_of(w):
    return {name.split("hour_sums/")[1] for name in w.hour_sums.inputFiles()}


def averages(cells):
    rows = cells.select(*demand.BASELINE_LEVELS["store_product_hour_avg"], *demand.BASELINE_LEVELS).collect()
    return {tuple(row)[:3]: tuple(row)[3:] for row in rows}


def test_a_reload_sums_up_the_periods_of_its_dates_only(warehouse, loaded):
    before = files_of(loaded)
    kept = {row.period for row in loaded.hour_sums.select("period").distinct().collect()}
    assert len(kept) > 1
    day = date(2024, 1, 24)
    changed = warehouse.observations.filter((F.col("store_id") < 4) & (F.col("dt") == F.lit(day)))
    loaded.load(changed.withColumn("hours_sale", F.transform("hours_sale", lambda sale: sale + 1)))
    loaded.load_hourly(day, day)
    again = reopened(loaded)
    replaced = (day - date(1970, 1, 1)).days // hour_sums.PERIOD_DAYS
    after = files_of(again)
    assert {name for name in before - after} == {name for name in before if f"period={replaced}/" in name}
    expected = averages(demand.baseline_cells(again.fact_hourly, again.dim_product))
    found = averages(again.baseline_cells)
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        assert found[key] == pytest.approx(values, nan_ok=True) if None not in values else found[key][1:] == pytest.approx(values[1:])


def test_a_reload_that_broke_off_leaves_no_old_sums(loaded):
    """The sums of its dates are gone before hours change; the next reader sums up what is there."""
    rows = loaded.hour_sums.count()
    day = date(2024, 1, 25)
    loaded._drop_sums(day, day)
    assert 0 < loaded.tables.read("hour_sums", S.HOUR_SUMS).count() < rows
    assert reopened(loaded).hour_sums.count() == rows


def test_the_fact_is_opened_for_missing_periods_only(loaded):
    last = date(2024, 1, 20)
    cells = loaded.prior_cells(last)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    opened = [line for line in plan.splitlines() if "fact_hourly" in line]
    assert opened and all("20240120" in line and "20240110" not in line for line in opened)


@pytest.mark.parametrize("last", [date(2023, 12, 31), date(2024, 1, 17), date(2024, 1, 20), date(2024, 3, 1)])
def test_cells_equal_those_of_the_rows(loaded, last):
    """At the end of a period, within one, before all dates and after them."""
    rows = loaded.training_features
    part = F.when((F.col("source_split") == "train") & (F.col("full_date") <= F.lit(last)), "fit").otherwise("eval")
    expected = features._cells(rows.withColumn("part", part))
    found = loaded.prior_cells(last)
    rounded = [F.round(F.coalesce("_sum", F.lit(-1.0)), 6).alias("_sum"), "_count", "_flagged", "_rows"]
    both = [cells.select(*features._CELL, *rounded) for cells in (expected, found.select(*expected.columns))]
    assert both[0].exceptAll(both[1]).isEmpty() and both[1].exceptAll(both[0]).isEmpty()


COLUMNS = ["product_sales_lag_1h", "product_sales_lag_24h_sum", "days_since_previous_sale"]


@pytest.mark.parametrize("steps", [[10], [0, 1, 2, 12], [29], [40]])
def test_lags_at_the_seam_equal_the_full_windows(spark, loaded, tmp_path, steps):
    """With pairs that pause, begin late or have sold nothing so far; also with nothing before or after."""
    rows = loaded.training_features.filter((F.col("product_id") % 3 != 1) | (F.dayofmonth("full_date") % 9 < 2))
    rows = rows.withColumn("observed_sales_amount", F.when(F.col("product_id") % 4 != 2, F.col("observed_sales_amount")).otherwise(0.0))
    days = [date(2023, 12, 31) + timedelta(days=n) for n in steps]
    state = Boundary.of(rows.filter(F.col("full_date") <= F.lit(days[0])))
    for start, end in zip(days, days[1:], strict=False):
        state = state.advance(rows.filter((F.col("full_date") > F.lit(start)) & (F.col("full_date") <= F.lit(end))))
    state.save(str(tmp_path / "state"))
    state = Boundary.load(spark, str(tmp_path / "state"))
    later = F.col("full_date") > F.lit(days[-1])
    found = state.lags(rows.filter(later)).select(*rows.columns, *COLUMNS)
    expected = features.lags(rows).filter(later).select(*rows.columns, *COLUMNS)
    assert found.exceptAll(expected).isEmpty() and found.count() == expected.count()
    held = state.hours.groupBy(*PAIR).count().agg(F.max("count")).first()[0]
    assert held is None or held <= ROWS
