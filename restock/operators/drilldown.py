"""Hour-by-hour evidence for store-product-days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock import schema as S
from restock.functions import scores
from restock.functions.hours import hour_label, hour_ranges, is_business_hour
from restock.functions.text import amount
from restock.operators.demand import model_estimates
from restock.session import never_broadcast

DAY = ["full_date", "store_id", "product_id"]


def _named(hourly: DataFrame, dates: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Natural keys beside the surrogate keys."""
    return (
        hourly.join(F.broadcast(dates.select("date_key", "full_date")), "date_key")
        .join(stores.select("store_key", "store_id"), "store_key")
        .join(products.select("product_key", "product_id"), "product_key")
        .withColumn("hour_of_day", F.col("time_key"))
    )


def select_day(df: DataFrame, day: date | Column, store_id: int, product_id: int) -> DataFrame:
    chosen = (F.col("full_date") == day) & (F.col("store_id") == store_id) & (F.col("product_id") == product_id)
    return df.filter(chosen)


def hourly_drilldown(
    hourly: DataFrame,
    dates: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    estimates: DataFrame,
    active: Column,
) -> DataFrame:
    """Hours with the active model's estimates joined straight from the fact.

    Conditions on date, store and product put on the result reach the dimensions, and from the
    date the scan of both facts by partition pruning.
    """
    named = _named(hourly, dates, stores, products)
    joined = named.join(never_broadcast(model_estimates(estimates, active)), S.HOURLY_KEY, "left")
    modelled, out = F.col("_has_model").isNotNull(), F.col("stockout_flag")
    basis = F.when(modelled, "model").when(out, "stockout").otherwise("observed")
    return joined.select(
        *DAY,
        "hour_of_day",
        "observed_sales_amount",
        F.coalesce("_demand", "observed_sales_amount").alias("estimated_true_demand"),
        F.coalesce("_lost", F.lit(0.0)).alias("estimated_lost_sales"),
        out.cast("int").alias("stockout_flag"),
        F.when(modelled, "model").otherwise("observed").alias("estimate_source"),
        scores.lookup(basis, S.DRILLDOWN_EXPLANATIONS).alias("estimate_explanation"),
    )


def hourly_drilldown_view(
    demand: DataFrame, dates: DataFrame, stores: DataFrame, products: DataFrame
) -> DataFrame:
    """Hours through the hourly demand estimates, whose baselines look at all rows."""
    return _named(demand, dates, stores, products).select(
        *DAY,
        "hour_of_day",
        "observed_sales_amount",
        "estimated_true_demand",
        "estimated_lost_sales",
        "stockout_flag",
        "estimate_source",
    )


def _out() -> Column:
    return F.coalesce(F.col("stockout_flag").cast("int"), F.lit(0)) >= 1


def hourly_status(drilldown: DataFrame) -> DataFrame:
    status = scores.hour_status(
        _out(),
        F.coalesce("estimated_lost_sales", F.lit(0.0)),
        F.coalesce("observed_sales_amount", F.lit(0.0)),
    )
    return drilldown.withColumn("status", status)


def hourly_evidence(drilldown: DataFrame) -> DataFrame:
    """The evidence table: hour text, status, amounts and the gap that was recovered."""
    gap = F.greatest(F.col("estimated_true_demand") - F.col("observed_sales_amount"), F.lit(0.0))
    return hourly_status(drilldown).select(
        *DAY,
        hour_label(F.col("hour_of_day")).alias("hour"),
        "status",
        "observed_sales_amount",
        "estimated_true_demand",
        "estimated_lost_sales",
        gap.alias("recovered_gap"),
        _out().alias("stockout_flag"),
        "estimate_source",
    )


def hour_class(drilldown: DataFrame) -> DataFrame:
    lost = F.coalesce("estimated_lost_sales", F.lit(0.0))
    return drilldown.withColumn("hour_class", scores.hour_class(F.col("hour_of_day"), _out(), lost))


def full_business_stockout(drilldown: DataFrame) -> DataFrame:
    """Days on which every business hour was out of stock."""
    return (
        drilldown.filter(is_business_hour(F.col("hour_of_day")))
        .groupBy(*DAY)
        .agg(F.bool_and(_out()).alias("is_full_business_stockout"))
    )


def melt_amounts(drilldown: DataFrame) -> DataFrame:
    """Observed and estimated amounts as a series column, for charts."""
    names = {"observed_sales_amount": "Observed sales", "estimated_true_demand": "Estimated demand"}
    stockout = F.when(_out(), "Stockout").otherwise("Available")
    long = drilldown.select(
        *DAY,
        "hour_of_day",
        hour_label(F.col("hour_of_day")).alias("hour_label"),
        stockout.alias("stockout_status"),
        "estimated_lost_sales",
        *names,
    ).unpivot(
        [*DAY, "hour_of_day", "hour_label", "stockout_status", "estimated_lost_sales"], list(names), "series", "amount"
    )
    return long.withColumn("series", scores.lookup(F.col("series"), names))


def stockout_hour_ranges(drilldown: DataFrame) -> DataFrame:
    """Stockout and lost-sales hours of each day as text; a day holds at most 24 hours."""
    hours_where = lambda condition: F.array_sort(F.collect_list(F.when(condition, F.col("hour_of_day"))))
    days = drilldown.groupBy(*DAY).agg(
        hours_where(_out()).alias("_stockout"), hours_where(F.col("estimated_lost_sales") > 0).alias("_lost")
    )
    return days.select(
        *DAY,
        hour_ranges(F.col("_stockout")).alias("stockout_ranges"),
        hour_ranges(F.col("_lost")).alias("lost_sales_ranges"),
    )


def hourly_story(drilldown: DataFrame) -> DataFrame:
    """Totals of each day and the hour that lost most, the earliest on ties."""
    business = is_business_hour(F.col("hour_of_day"))
    lost = F.col("estimated_lost_sales")
    return drilldown.groupBy(*DAY).agg(
        F.count_if(_out()).alias("stockout_hours"),
        F.count_if(_out() & business).alias("business_stockout_hours"),
        F.coalesce(F.sum(lost), F.lit(0.0)).alias("lost_sales"),
        F.coalesce(F.sum("observed_sales_amount"), F.lit(0.0)).alias("observed_sales"),
        F.coalesce(F.sum("estimated_true_demand"), F.lit(0.0)).alias("estimated_demand"),
        F.max_by("hour_of_day", F.struct(lost, -F.col("hour_of_day"))).alias("peak_hour"),
    )


# Readout texts of the hourly story.
NO_STOCKOUT_TEXT = (
    "No source stockout hours are present for this store-product-day. "
    "The recommendation is driven by non-stockout demand, waste, or queue context."
)
NOTHING_RECOVERED_TEXT = (
    "Source stockout flags are present, but the model/fallback did not recover material lost sales "
    "for those hours. Treat this as a stockout evidence check."
)
RECOVERED_TEXT = (
    "Stockout is observed during %s. The model recovers lost demand during %s, "
    "with the peak lost-sales signal at %d:00."
)
TOTALS_TEXT = (
    "Observed sales total %s, estimated demand totals %s, and the recovered gap is %s. "
    "This supports the action: %s."
)


def story_readout(drilldown: DataFrame, decisions: DataFrame) -> DataFrame:
    """What the hours of a day say, and which action they support."""
    told = hourly_story(drilldown).join(never_broadcast(stockout_hour_ranges(drilldown)), DAY)
    readout = (
        F.when(F.col("stockout_hours") == 0, NO_STOCKOUT_TEXT)
        .when(F.col("lost_sales") <= 0, NOTHING_RECOVERED_TEXT)
        .otherwise(F.format_string(RECOVERED_TEXT, "stockout_ranges", "lost_sales_ranges", "peak_hour"))
    )
    label = scores.lookup(F.col("decision_action"), S.ACTION_LABELS)
    totals = [amount(F.col(name)) for name in ("observed_sales", "estimated_demand", "lost_sales")]
    return told.join(never_broadcast(decisions.select(*DAY, "decision_action")), DAY).select(
        *DAY, readout.alias("readout"), F.format_string(TOTALS_TEXT, *totals, label).alias("explanation")
    )
