"""Roll-ups of the facts and of the decision view.

Every one is a single aggregation with map-side combine; no row leaves its task before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock import schema as S
from restock.functions import scores


def _action_count(action: str) -> Column:
    return F.count_if(F.col("decision_action") == action)


def stockout_rate_by_category(daily: DataFrame, products: DataFrame) -> DataFrame:
    totals = (
        daily.join(products, "product_key")
        .groupBy(*S.CATEGORY_LEVELS)
        .agg(
            F.count(F.lit(1)).alias("product_store_days"),
            F.sum("stockout_hours_6_22").alias("stockout_hours_6_22"),
            F.sum("observed_daily_sales_amount").alias("observed_sales_amount"),
        )
    )
    possible = F.nullif(F.col("product_store_days") * S.BUSINESS_HOURS, F.lit(0))
    rate = F.round(F.try_divide(F.col("stockout_hours_6_22"), possible) + 1e-9, 6)
    return totals.withColumn("stockout_rate_6_22", rate)


def top_stockout_categories(by_category: DataFrame, n: int = 20) -> DataFrame:
    return by_category.orderBy(F.desc("stockout_rate_6_22"), *S.CATEGORY_LEVELS).limit(n)


def trainable_counts(features: DataFrame) -> DataFrame:
    return (
        features.groupBy("source_split", "is_trainable_demand_observation")
        .agg(F.count(F.lit(1)).alias("hourly_rows"))
        .orderBy("source_split", F.desc("is_trainable_demand_observation"))
    )


def daily_trend(daily: DataFrame, dates: DataFrame) -> DataFrame:
    """Aggregated by date key first, so the calendar joins one row per date."""
    return (
        daily.groupBy("date_key")
        .agg(
            F.sum("observed_daily_sales_amount").alias("observed_sales_amount"),
            F.sum("stockout_hours_6_22").alias("stockout_hours_6_22"),
            F.count_if("has_stockout").alias("stockout_product_store_days"),
        )
        .join(F.broadcast(dates.select("date_key", "full_date")), "date_key")
        .drop("date_key")
        .orderBy("full_date")
    )


def _decision_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("product_store_days"),
        F.sum("observed_daily_sales_amount").alias("observed_sales_amount"),
        F.sum("estimated_true_demand").alias("estimated_true_demand"),
        F.sum("estimated_lost_sales").alias("estimated_lost_sales"),
        F.avg("stockout_rate_6_22").alias("avg_stockout_rate_6_22"),
        F.avg("waste_risk_score").alias("avg_waste_risk_score"),
        F.avg("demand_bias_rate").alias("avg_demand_bias_rate"),
        F.avg("restock_urgency_score").alias("avg_restock_urgency_score"),
        F.sum("recommended_order_qty").alias("recommended_order_qty"),
        _action_count(S.RESTOCK).alias("immediate_restock_count"),
    ]


def kpi_by(decisions: DataFrame, keys: list[str]) -> DataFrame:
    """Eleven measures per key: the daily KPIs by date, the category KPIs by the four levels."""
    return decisions.groupBy(*keys).agg(
        *_decision_measures(), _action_count(S.REDUCE).alias("waste_action_count")
    )


def summary(decisions: DataFrame) -> DataFrame:
    """One row over all decisions; sums and averages of nothing are null."""
    return decisions.agg(
        *_decision_measures(),
        _action_count(S.INCREASE).alias("increase_order_count"),
        _action_count(S.REDUCE).alias("reduce_order_count"),
        _action_count(S.REVIEW).alias("review_bias_count"),
    )


def trend(decisions: DataFrame) -> DataFrame:
    rates = ["stockout_rate_6_22", "waste_risk_score", "demand_bias_rate", "restock_urgency_score"]
    return (
        decisions.groupBy("full_date")
        .agg(
            F.sum("observed_daily_sales_amount").alias("observed_sales_amount"),
            F.sum("estimated_lost_sales").alias("estimated_lost_sales"),
            *[F.avg(name).alias(name) for name in rates],
        )
        .orderBy("full_date")
    )


def category_pressure(decisions: DataFrame, n: int = 20) -> DataFrame:
    rates = ["stockout_rate_6_22", "waste_risk_score", "restock_urgency_score"]
    return (
        decisions.groupBy("first_category_id")
        .agg(
            F.count(F.lit(1)).alias("product_store_days"),
            F.sum("observed_daily_sales_amount").alias("observed_sales_amount"),
            F.sum("estimated_lost_sales").alias("estimated_lost_sales"),
            *[F.avg(name).alias(name) for name in rates],
        )
        .orderBy(F.desc("restock_urgency_score"), F.desc("estimated_lost_sales"), "first_category_id")
        .limit(n)
    )


def category_bands(pressure: DataFrame) -> DataFrame:
    return pressure.withColumn("pressure_band", scores.pressure_band(F.col("restock_urgency_score")))


def action_distribution(decisions: DataFrame) -> DataFrame:
    """Rows and mean scores per model and action; no model is a group of its own."""
    mean = lambda name: F.round(F.avg(name) + 1e-9, 4)
    return (
        decisions.groupBy("model_name", "model_version", "decision_action")
        .agg(
            F.count(F.lit(1)).alias("product_store_days"),
            mean("stockout_rate_6_22").alias("avg_stockout_rate"),
            mean("waste_risk_score").alias("avg_waste_risk"),
            mean("demand_bias_rate").alias("avg_demand_bias"),
            mean("restock_urgency_score").alias("avg_restock_urgency"),
        )
        .orderBy(F.desc("avg_restock_urgency"), "decision_action")
    )


def action_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("decision_action").agg(F.count(F.lit(1)).alias("product_store_days"))


def what_if(decisions: DataFrame, urgency_threshold: float, service_level: float) -> DataFrame:
    """Counts of the actions under another urgency threshold, and the order quantity re-scaled."""
    urgent = F.col("restock_urgency_score") >= urgency_threshold
    short = F.col("stockout_rate_6_22") >= S.STOCKOUT_RATE_THRESHOLD
    wasteful = F.col("waste_risk_score") >= S.WASTE_THRESHOLD
    hidden = F.col("demand_bias_rate") >= S.BIAS_THRESHOLD
    rescaled = F.col("recommended_order_qty") * F.try_divide(F.lit(service_level), F.col("service_level_target"))
    return decisions.agg(
        F.count(F.lit(1)).alias("product_store_days"),
        F.count_if(urgent).alias("restock_count"),
        F.count_if(~urgent & short).alias("increase_order_count"),
        F.count_if(~urgent & ~short & wasteful).alias("markdown_count"),
        F.count_if(~urgent & ~short & ~wasteful & hidden).alias("review_bias_count"),
        F.sum(F.when(urgent, rescaled).otherwise(0.0)).alias("restock_order_qty_proxy"),
    )


def action_lanes(queue: DataFrame) -> DataFrame:
    """The visible queue by action, in the order of the lanes."""
    rank = scores.order_rank(F.col("decision_action"), S.LANE_ORDER, 99)
    return (
        queue.groupBy("decision_action")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("estimated_lost_sales").alias("lost_sales"),
            F.avg("restock_urgency_score").alias("avg_priority"),
            F.avg("stockout_rate_6_22").alias("avg_stockout"),
        )
        .withColumn("action_label", scores.lookup(F.col("decision_action"), S.ACTION_LABELS))
        .orderBy(rank, F.desc("lost_sales"))
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every table."""
    from functools import reduce

    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).select("table_name", "row_count")


def data_status(tables: dict[str, DataFrame], dates: DataFrame) -> DataFrame:
    """One row: rows of each table, first and last date."""
    counts = [df.agg(F.count(F.lit(1))).scalar().alias(f"{name}_rows") for name, df in tables.items()]
    span = dates.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"))
    return span.select(*counts, "min_date", "max_date")


def filter_options(products: DataFrame, stores: DataFrame) -> DataFrame:
    """The values the filters offer, as sorted (option_kind, option_value)."""

    def option(df: DataFrame, kind: str, name: str) -> DataFrame:
        return df.select(F.lit(kind).alias("option_kind"), F.col(name).alias("option_value")).distinct()

    return (
        option(products, "category", "first_category_id")
        .unionByName(option(stores, "store", "store_id"))
        .unionByName(option(products, "product", "product_id"))
        .orderBy("option_kind", "option_value")
    )
