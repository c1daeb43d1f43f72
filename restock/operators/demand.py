"""Demand behind stockouts: baselines, heuristic estimates and model estimates by hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock import schema as S
from restock.functions.scores import bias_rate, lookup, stockout_rate, urgency
from restock.session import materialise, never_broadcast

# From the most specific to the most general: average -> grouping keys.
BASELINE_LEVELS = {
    "store_product_hour_avg": ["store_key", "product_key", "time_key"],
    "product_hour_avg": ["product_key", "time_key"],
    "category_hour_avg": ["first_category_id", "time_key"],
    "product_avg": ["product_key"],
    "global_hour_avg": ["time_key"],
}


def baseline_cells(hourly: DataFrame, products: DataFrame) -> DataFrame:
    """The five non-stockout averages for every (store, product, hour).

    The fact is aggregated once, with map-side combine, to one row per store, product and hour, and
    written; coarser averages are rolled up from those sums and counts. No group of fact rows ever
    has to sit in one task, however many rows an hour or a product has.
    """
    sold = F.when(~F.col("stockout_flag"), F.col("observed_sales_amount"))
    sums = [F.sum(sold).alias("_sum"), F.count(sold).alias("_count")]
    return _rolled_up(hourly.groupBy(*BASELINE_LEVELS["store_product_hour_avg"]).agg(*sums), products)


def baseline_cells_of_sums(hour_sums: DataFrame, products: DataFrame) -> DataFrame:
    """The same from stored sums by period (``hour_sums``), without the fact."""
    sums = [F.sum("sold_sum").alias("_sum"), F.sum("sold_count").alias("_count")]
    return _rolled_up(hour_sums.groupBy(*BASELINE_LEVELS["store_product_hour_avg"]).agg(*sums), products)


def _rolled_up(sums: DataFrame, products: DataFrame) -> DataFrame:
    finest = BASELINE_LEVELS["store_product_hour_avg"]
    cells = materialise(sums.join(products.select("product_key", "first_category_id"), "product_key"))
    result = cells
    for name, keys in BASELINE_LEVELS.items():
        if keys == finest:
            result = result.withColumn(name, F.try_divide("_sum", "_count"))
        else:
            total = cells.groupBy(*keys).agg(F.try_divide(F.sum("_sum"), F.sum("_count")).alias(name))
            result = result.join(total, keys, "left")
    return materialise(result.select(*finest, *BASELINE_LEVELS))


def with_baselines(hourly: DataFrame, cells: DataFrame) -> DataFrame:
    """The hourly fact with the five averages beside each row: one join, on the finest key."""
    return hourly.join(never_broadcast(cells), BASELINE_LEVELS["store_product_hour_avg"], "left")


def baseline_averages(hourly: DataFrame, products: DataFrame) -> DataFrame:
    return with_baselines(hourly, baseline_cells(hourly, products))


def fallback_choice(observed: Column) -> Column:
    """The first average that exists, else what was observed."""
    return F.coalesce(*[F.col(name) for name in BASELINE_LEVELS], observed)


def heuristic_demand(with_baselines: DataFrame) -> DataFrame:
    """Demand and lost sales of stockout hours from the baselines; other hours keep their sales."""
    observed, out = F.col("observed_sales_amount"), F.col("stockout_flag")
    baseline = fallback_choice(observed)
    return with_baselines.withColumns(
        {
            "heuristic_true_demand": F.when(out, F.greatest(baseline, observed)).otherwise(observed),
            "heuristic_lost_sales": F.when(out, F.greatest(baseline - observed, F.lit(0.0))).otherwise(0.0),
        }
    ).drop(*BASELINE_LEVELS)


def model_estimates(estimates: DataFrame, active: Column) -> DataFrame:
    """The active model's estimates; the key reaches the scan as a partition filter."""
    return estimates.filter(F.col("model_key") == active["model_key"]).select(
        *S.HOURLY_KEY,
        F.col("estimated_true_demand").alias("_demand"),
        F.col("estimated_lost_sales").alias("_lost"),
        F.lit(True).alias("_has_model"),
    )


def hourly_demand_estimate(hourly: DataFrame, cells: DataFrame, estimates: DataFrame, active: Column) -> DataFrame:
    """Heuristic estimates, overridden row by row where the active model has one."""
    heuristic = heuristic_demand(with_baselines(hourly, cells))
    joined = heuristic.join(never_broadcast(model_estimates(estimates, active)), S.HOURLY_KEY, "left")
    modelled = F.col("_has_model").isNotNull()
    basis = F.when(modelled, "model").when(F.col("stockout_flag"), "stockout").otherwise("observed")
    carried = [name for name in S.FACT_HOURLY.names]
    return joined.withColumn("_active", active).select(
        *carried,
        F.coalesce("_demand", "heuristic_true_demand").alias("estimated_true_demand"),
        F.coalesce("_lost", "heuristic_lost_sales").alias("estimated_lost_sales"),
        F.col("_active.model_key").alias("model_key"),
        F.col("_active.model_name").alias("model_name"),
        F.col("_active.model_version").alias("model_version"),
        F.when(modelled, "model").otherwise("heuristic").alias("estimate_source"),
        lookup(basis, S.HOURLY_EXPLANATIONS).alias("estimate_explanation"),
    )


def clamp_prediction(predictions: DataFrame) -> DataFrame:
    """Turn ``predicted_demand`` into demand, lost sales and bounds.

    A stockout hour's demand is at least what was sold; any other hour's demand is what was sold.
    """
    observed, out = F.col("observed_sales_amount"), F.col("stockout_flag")
    demand = F.col("estimated_true_demand")

    def bound(factor: float) -> Column:
        return F.when(out, F.greatest(demand * factor, observed)).otherwise(observed)

    floored = predictions.withColumn("predicted_demand", F.greatest("predicted_demand", F.lit(0.0))).withColumn(
        "estimated_true_demand", F.when(out, F.greatest("predicted_demand", observed)).otherwise(observed)
    )
    return floored.withColumns(
        {
            "estimated_lost_sales": F.when(out, F.greatest(demand - observed, F.lit(0.0))).otherwise(0.0),
            "prediction_lower_bound": bound(S.LOWER_BOUND_FACTOR),
            "prediction_upper_bound": bound(S.UPPER_BOUND_FACTOR),
        }
    )


def as_estimates(clamped: DataFrame, model_key) -> DataFrame:
    """Clamped predictions in the layout of the estimate fact."""
    key = model_key if hasattr(model_key, "cast") else F.lit(model_key)
    return clamped.withColumns(
        {"model_key": key.cast("int"), "is_censored_observation": F.col("stockout_flag")}
    ).select(*S.DEMAND_ESTIMATE.names)


_DERIVABLE = ("estimated_lost_sales", "prediction_lower_bound", "prediction_upper_bound")


def import_predictions(predictions: DataFrame, model_key: int) -> DataFrame:
    """A prediction file of any supported layout as rows of the estimate fact.

    Required are the keys, observed sales and the stockout flag, and one of
    ``estimated_true_demand`` and ``predicted_demand``. What is missing is derived; values that do
    not read as numbers count as 0, and a missing stockout flag as a stockout.
    """
    required = {*S.HOURLY_KEY, "observed_sales_amount", "stockout_flag"}
    missing = sorted(required - set(predictions.columns))
    if missing:
        raise ValueError(f"prediction file is missing required columns: {missing}")
    given = [c for c in ("estimated_true_demand", "predicted_demand") if c in predictions.columns]
    if not given:
        raise ValueError("prediction file must contain either estimated_true_demand or predicted_demand")

    def number(name: str, kind: str = "double") -> Column:
        return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)).cast(kind)

    observed, out = F.col("observed_sales_amount"), F.col("stockout_flag")
    clean = predictions.select(
        *[number(key, "int").alias(key) for key in S.HOURLY_KEY],
        number("observed_sales_amount").alias("observed_sales_amount"),
        F.coalesce(F.col("stockout_flag").cast("boolean"), F.lit(True)).alias("stockout_flag"),
        number(given[0]).alias("_demand"),
        *[number(name).alias(f"_{name}") for name in _DERIVABLE if name in predictions.columns],
    )
    if given[0] == "predicted_demand":
        clean = clean.withColumn("_demand", F.when(out, F.greatest("_demand", observed)).otherwise(observed))

    demand = F.when(out, F.greatest("_demand", observed)).otherwise(observed)
    lost = F.greatest(demand - observed, F.lit(0.0))
    if "_estimated_lost_sales" in clean.columns:
        # Derived and supplied lost sales may differ; the larger one stands.
        lost = F.greatest(lost, F.col("_estimated_lost_sales"))

    def bound(name: str, factor: float) -> Column:
        if f"_{name}" in clean.columns:
            return F.col(f"_{name}")
        return F.when(out, F.greatest(F.col("_demand") * factor, observed)).otherwise(observed)

    completed = clean.withColumns(
        {
            "estimated_true_demand": demand,
            "estimated_lost_sales": F.when(out, lost).otherwise(0.0),
            "prediction_lower_bound": bound("prediction_lower_bound", S.LOWER_BOUND_FACTOR),
            "prediction_upper_bound": bound("prediction_upper_bound", S.UPPER_BOUND_FACTOR),
        }
    )
    return as_estimates(completed, model_key)


def recommendations(
    estimates: DataFrame, daily: DataFrame, service_level: float = S.SERVICE_LEVEL
) -> DataFrame:
    """Daily order quantities and risks of every model found in the estimates."""
    per_day = estimates.groupBy(*S.RECOMMENDATION_KEY).agg(
        F.sum("estimated_true_demand").alias("expected_demand"),
        F.sum("estimated_lost_sales").alias("expected_lost_sales"),
    )
    measures = daily.select(
        *S.DAILY_KEY, "observed_daily_sales_amount", "stockout_hours_6_22", "activity_flag"
    )
    demand = F.col("expected_demand")
    risk = urgency(
        stockout_rate(F.col("stockout_hours_6_22")),
        bias_rate(F.col("expected_lost_sales"), demand),
        F.col("activity_flag"),
    )
    return per_day.join(never_broadcast(measures), S.DAILY_KEY).select(
        *S.RECOMMENDATION_KEY,
        F.greatest(demand * service_level / S.SERVICE_LEVEL, F.lit(0.0)).alias("recommended_order_qty"),
        "expected_demand",
        "expected_lost_sales",
        risk.alias("stockout_risk_score"),
        F.greatest(F.col("observed_daily_sales_amount") - demand, F.lit(0.0)).alias("expected_waste_qty"),
        F.lit(service_level).alias("service_level_target"),
    )
