"""What must hold on any data: totals, bounds, baselines against windows, features against brute force."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from restock import fixtures
from restock import schema as S
from restock.operators import comparison, demand, evaluation, features, merge, quality


def test_hourly_sums_back_to_daily(warehouse):
    hourly = warehouse.fact_hourly.groupBy(*S.DAILY_KEY).agg(
        F.count("*").alias("hours"), F.sum("observed_sales_amount").alias("sales")
    )
    joined = warehouse.fact_daily.join(hourly, S.DAILY_KEY, "full")
    assert joined.filter((F.col("hours") != 24) | F.col("hours").isNull()).isEmpty()
    assert joined.filter(F.abs(F.col("sales") - F.col("observed_daily_sales_amount")) > 1e-6).isEmpty()


def test_estimates_stay_within_their_bounds(warehouse):
    e = warehouse.demand_estimates
    assert e.filter(F.col("estimated_lost_sales") < 0).isEmpty()
    assert e.filter(F.col("estimated_true_demand") < F.col("observed_sales_amount")).isEmpty()
    assert e.filter(~F.col("stockout_flag") & (F.col("estimated_true_demand") != F.col("observed_sales_amount"))).isEmpty()


def test_scores_are_shares_and_actions_partition_the_days(warehouse):
    d = warehouse.decision_scores
    for name in ("stockout_rate_6_22", "demand_bias_rate", "waste_risk_score", "restock_urgency_score"):
        assert d.filter(~F.col(name).between(0, 1)).isEmpty()
    counts = {r.decision_action: r["count"] for r in d.groupBy("decision_action").count().collect()}
    assert set(counts) == set(S.LANE_ORDER)
    assert sum(counts.values()) == warehouse.fact_daily.count()


def test_newest_model_without_predictions_is_not_active(warehouse):
    active = warehouse.spark.range(1).select(warehouse.active_model.alias("m")).first().m
    assert active.model_key == 2


def test_baselines_equal_windows_with_a_hot_product(spark):
    rows = [
        (d, h, s, p, "train", float((d * h * s) % 5), (d + h + s) % 3 == 0)
        for p, stores in ((1, 12), (2, 3), (3, 1))
        for s in range(stores)
        for d in range(6)
        for h in range(24)
    ]
    hourly = spark.createDataFrame(
        rows, "date_key int, time_key int, store_key int, product_key int, source_split string, observed_sales_amount double, stockout_flag boolean"
    )
    products = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "product_key int, first_category_id bigint")
    sold = F.when(~F.col("stockout_flag"), F.col("observed_sales_amount"))
    windows = hourly.join(products, "product_key").withColumns(
        {f"w_{name}": F.avg(sold).over(Window.partitionBy(*keys)) for name, keys in demand.BASELINE_LEVELS.items()}
    )
    both = windows.join(demand.baseline_averages(hourly, products).select(*S.HOURLY_KEY, *demand.BASELINE_LEVELS), S.HOURLY_KEY)
    assert both.count() == len(rows)
    for name in demand.BASELINE_LEVELS:
        differ = ~F.round(F.col(name), 9).eqNullSafe(F.round(F.col(f"w_{name}"), 9))
        assert both.filter(differ).isEmpty()


def test_quality_counts_of_broken_rows(warehouse):
    obs = warehouse.observations
    case = (F.col("store_id") * 31 + F.col("product_id") + F.dayofmonth("dt")) % 97
    known = {r.c: r["count"] for r in obs.groupBy(case.alias("c")).count().collect()}
    report = {r.check_name: r.failed_rows for r in quality.data_quality_checks(fixtures.broken_observations(obs)).collect()}
    assert report["hours_sale_length_24"] == report["hours_stock_status_length_24"] == known[0]
    assert report["duplicate_staging_grain"] == known[3]
    assert report["business_hour_stockout_count_matches"] >= known[1]
    assert report["daily_sales_equals_hourly_sum"] >= known[2]
    assert all(r.failed_rows == 0 for r in quality.data_quality_checks(obs).collect())


def test_null_arrays_fail_the_length_checks(warehouse):
    obs = warehouse.observations.withColumn("hours_sale", F.lit(None).cast("array<double>"))
    assert quality.single_check(obs, "hours_sale_length_24").first().failed_rows == obs.count()


def test_upsert_is_idempotent_and_refuses_duplicates(warehouse):
    daily = warehouse.fact_daily
    incoming = daily.filter(F.col("date_key") >= 20240125).withColumn("discount_rate", F.lit(0.5))
    once = merge.upsert(daily, incoming, S.DAILY_KEY)
    twice = merge.upsert(once, incoming, S.DAILY_KEY)
    assert once.count() == daily.count()
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()
    with pytest.raises(merge.DuplicateKeyError):
        merge.upsert(daily, incoming.unionByName(incoming), S.DAILY_KEY)


def test_single_date_splits_by_position(spark):
    rows = [("train", "2024-01-01", h, s, 1, 1.0) for s in range(10) for h in range(24)]
    df = spark.createDataFrame(rows, "source_split string, d string, time_key int, store_id int, product_id int, x double")
    parts = features.temporal_holdout(df.withColumn("full_date", F.to_date("d")), 0.25)
    counts = {r.part: r["count"] for r in parts.groupBy("part").count().collect()}
    assert counts == {"fit": 180, "calibration": 60}
    last_fit = parts.filter("part = 'fit'").agg(F.max(F.struct("time_key", "store_id"))).first()[0]
    first_cal = parts.filter("part = 'calibration'").agg(F.min(F.struct("time_key", "store_id"))).first()[0]
    assert tuple(last_fit) < tuple(first_cal)


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "demand_target double, prediction double")


PAIRS = [(float((i * 7) % 11), ((i * 5) % 13) / 4) for i in range(200)] + [(0.0, 2.0)] * 100 + [(3.0, 0.0)] * 5


@pytest.mark.parametrize("penalty, steps, lower, upper", [(0.25, 121, 0.25, 5.0), (0.0, 41, 0.5, 3.0), (1.0, 3, 0.1, 0.9)])
def test_calibration_equals_the_grid_search(spark, penalty, steps, lower, upper):
    row = evaluation.calibration_factor(scored(spark, PAIRS), "balanced", lower, upper, penalty, steps).first()
    total = sum(y for y, _ in PAIRS)

    def score(f):
        return round(sum(abs(p * f - y) for y, p in PAIRS) / total + penalty * abs(sum(p * f - y for y, p in PAIRS)) / total, 12)

    grid = [lower + i * (upper - lower) / (steps - 1) for i in range(steps)]
    extra = [1.0, *(min(max(f, lower), upper) for f in (row.raw_bias_factor, row.raw_wmape_factor))]
    assert score(row.calibration_factor) == pytest.approx(min(map(score, grid + extra)), abs=1e-9)


def test_weighted_median_by_brute_force(spark):
    weights = sorted((y / p, p) for y, p in PAIRS if p > 1e-12)
    half, running = sum(w for _, w in weights) / 2, 0.0
    for ratio, weight in weights:
        running += weight
        if running >= half - 1e-12:
            break
    assert evaluation.wmape_factor(scored(spark, PAIRS)).first().wmape_factor == pytest.approx(ratio)


def test_factors_of_nothing_are_one(spark):
    empty = scored(spark, [(1.0, 0.0)])
    assert evaluation.bias_factor(empty).first().bias_factor == 1.0
    assert evaluation.wmape_factor(empty).first().wmape_factor == 1.0


def test_unknown_categories_get_their_code(spark):
    base = {name: "a" for name in S.COMPARISON_CATEGORICAL}
    numbers = {name: 1.0 for name in S.COMPARISON_NUMERIC}
    rows = [{**base, **numbers, "store_id": value} for value in ("10", "2", "9")]
    frame = spark.createDataFrame(rows)
    fit = frame.filter("store_id <> '9'")
    codes = {r.store_id for r in comparison.comparison_encode(frame, fit).select("store_id").collect()}
    assert codes == {0, 1, comparison.UNKNOWN_CODE}
