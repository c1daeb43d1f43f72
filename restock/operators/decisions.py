"""Daily decision scores and the filters of the decision views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock import schema as S
from restock.functions import scores
from restock.operators.facts import daily_with_places
from restock.session import never_broadcast


def product_average(daily: DataFrame) -> DataFrame:
    """Average daily sales per product over the whole fact."""
    return daily.groupBy("product_key").agg(F.avg("observed_daily_sales_amount").alias("product_avg_daily_sales"))


def decision_inputs(
    daily: DataFrame,
    dates: DataFrame,
    stores: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    recommendations: DataFrame,
    active: Column,
) -> DataFrame:
    """The daily fact with its attributes, the product's average and the active model's figures.

    Days without a model row take their observed sales as demand and lose nothing.
    """
    figures = [
        "recommended_order_qty",
        "expected_demand",
        "expected_lost_sales",
        "expected_waste_qty",
        "service_level_target",
    ]
    of_model = recommendations.filter(F.col("model_key") == active["model_key"]).select(
        *S.DAILY_KEY, *[F.col(name).alias(f"model_{name}") for name in figures], F.lit(True).alias("_has_model")
    )
    observed = F.col("observed_daily_sales_amount")
    return (
        daily_with_places(daily, dates, stores, cities, products)
        .join(product_average(daily), "product_key")
        .join(never_broadcast(of_model), S.DAILY_KEY, "left")
        .withColumn("_active", active)
        .withColumns(
            {
                "model_name": F.col("_active.model_name"),
                "model_version": F.col("_active.model_version"),
                "estimate_source": F.when(F.col("_has_model"), "model").otherwise("daily_fact_only"),
                "estimated_true_demand": F.coalesce("model_expected_demand", observed),
                "estimated_lost_sales": F.coalesce("model_expected_lost_sales", F.lit(0.0)),
            }
        )
        .drop("_active", "_has_model")
    )


def with_scores(inputs: DataFrame) -> DataFrame:
    """Stockout rate, lost share, waste risk and urgency."""
    sales, rate, bias = F.col("observed_daily_sales_amount"), F.col("stockout_rate_6_22"), F.col("demand_bias_rate")
    return inputs.withColumns(
        {
            "stockout_rate_6_22": scores.stockout_rate(F.col("stockout_hours_6_22")),
            "demand_bias_rate": scores.bias_rate(F.col("estimated_lost_sales"), F.col("estimated_true_demand")),
            "waste_risk_score": scores.waste_risk(F.col("has_stockout"), sales, F.col("product_avg_daily_sales")),
        }
    ).withColumn("restock_urgency_score", scores.urgency(rate, bias, F.col("activity_flag")))


def with_order_proxies(scored: DataFrame) -> DataFrame:
    """Order quantity, service level and waste: the model's, else derived from the day itself."""
    sales, demand, zero = F.col("observed_daily_sales_amount"), F.col("estimated_true_demand"), F.lit(0.0)
    return scored.withColumns(
        {
            "recommended_order_qty": F.coalesce("model_recommended_order_qty", F.greatest(demand, zero)),
            "service_level_target": F.coalesce("model_service_level_target", F.lit(S.SERVICE_LEVEL)),
            "expected_waste_qty": F.coalesce("model_expected_waste_qty", F.greatest(sales - demand, zero)),
        }
    )


def with_decisions(scored: DataFrame) -> DataFrame:
    action = scores.decision_action(
        F.col("restock_urgency_score"),
        F.col("stockout_rate_6_22"),
        F.col("waste_risk_score"),
        F.col("demand_bias_rate"),
    )
    return scored.withColumn("decision_action", action).withColumns(
        {
            "decision_reason": scores.lookup(F.col("decision_action"), S.DECISION_REASONS),
            "inventory_proxy_note": F.lit(S.INVENTORY_NOTE),
        }
    )


def decision_scores(inputs: DataFrame) -> DataFrame:
    """The daily decision view."""
    return with_decisions(with_order_proxies(with_scores(inputs)))


def decision_filter(
    decisions: DataFrame,
    start: date | None = None,
    end: date | None = None,
    first_category_id: int | None = None,
    store_id: int | None = None,
    product_id: int | None = None,
    action: str | None = None,
) -> DataFrame:
    """Rows that meet all the given conditions."""
    equal = {
        "first_category_id": first_category_id,
        "store_id": store_id,
        "product_id": product_id,
        "decision_action": action,
    }
    result = decisions
    if start is not None:
        result = result.filter(F.col("full_date") >= F.lit(start))
    if end is not None:
        result = result.filter(F.col("full_date") <= F.lit(end))
    for name, value in equal.items():
        if value is not None:
            result = result.filter(F.col(name) == value)
    return result


def default_window(dates: DataFrame, days: int = 7) -> DataFrame:
    """The last days of the calendar, not reaching before its first date."""
    first, last = F.min("full_date"), F.max("full_date")
    return dates.agg(F.greatest(first, F.date_sub(last, days - 1)).alias("start_date"), last.alias("end_date"))


def in_default_window(decisions: DataFrame, dates: DataFrame) -> DataFrame:
    window = default_window(dates).select(F.struct("start_date", "end_date")).scalar()
    return decisions.filter(F.col("full_date").between(window["start_date"], window["end_date"]))


def restock_monitor(
    daily: DataFrame, dates: DataFrame, stores: DataFrame, cities: DataFrame, products: DataFrame
) -> DataFrame:
    """The daily fact with its attributes and a stockout priority."""
    placed = daily_with_places(daily, dates, stores, cities, products)
    return placed.select(
        "full_date",
        "city_id",
        "store_id",
        "product_id",
        *S.CATEGORY_LEVELS,
        "source_split",
        "observed_daily_sales_amount",
        "stockout_hours_6_22",
        "stockout_hours_total",
        "has_stockout",
        "discount_rate",
        "activity_flag",
        "avg_temperature",
        "precpt",
        scores.restock_priority(F.col("stockout_hours_6_22")).alias("restock_priority"),
    )


def restock_watchlist(monitor: DataFrame, day: date | Column, n: int = 50) -> DataFrame:
    """The most urgent rows of one day."""
    urgent = monitor.filter((F.col("full_date") == day) & F.col("restock_priority").isin("critical", "high"))
    return urgent.orderBy(
        F.desc("stockout_hours_6_22"), F.desc("observed_daily_sales_amount"), "store_id", "product_id"
    ).limit(n)
