"""Daily and hourly facts.

The calendar is broadcast, being bounded by its dates. Store and product dimensions carry no
hint: Spark broadcasts them while their size allows and shuffles, with skew handling, beyond.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock import schema as S
from restock.functions.hours import array_total


def _with_keys(obs: DataFrame, dates: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    calendar = dates.select("date_key", F.col("full_date").alias("dt"))
    return (
        obs.join(F.broadcast(calendar), "dt")
        .join(stores.select("store_key", "store_id"), "store_id")
        .join(products.select("product_key", "product_id"), "product_id")
    )


def fact_daily(obs: DataFrame, dates: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """``has_stockout`` looks at all 24 hours, ``stockout_hours_6_22`` at the business hours."""
    keyed = _with_keys(obs, dates, stores, products).withColumn(
        "stockout_hours_total", array_total(F.col("hours_stock_status"), 0)
    )
    renamed = {
        "observed_daily_sales_amount": F.col("sale_amount"),
        "stockout_hours_6_22": F.col("stock_hour6_22_cnt"),
        "has_stockout": F.col("stockout_hours_total") > 0,
        "discount_rate": F.col("discount"),
    }
    return keyed.withColumns(renamed).select(*S.FACT_DAILY.names)


def fact_hourly(
    obs: DataFrame,
    dates: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """24 rows per observation; keys are joined before the rows multiply."""
    if start is not None and end is not None and start > end:
        raise ValueError("the first date must not be after the last one")
    days = obs
    if start is not None:
        days = days.filter(F.col("dt") >= F.lit(start))
    if end is not None:
        days = days.filter(F.col("dt") <= F.lit(end))
    keyed = _with_keys(days, dates, stores, products)
    hours = F.posexplode(F.arrays_zip("hours_sale", "hours_stock_status")).alias("time_key", "hour")
    carried = ["date_key", "store_key", "product_key", "source_split", "discount"]
    weather = ["activity_flag", "precpt", "avg_temperature", "avg_humidity", "avg_wind_level"]
    exploded = keyed.select(*carried, *weather, hours)
    flagged = F.col("hour.hours_stock_status") == 1
    return exploded.withColumns(
        {
            "observed_sales_amount": F.col("hour.hours_sale"),
            "stockout_flag": flagged,
            "is_censored_observation": flagged,
            "discount_rate": F.col("discount"),
        }
    ).select(*S.FACT_HOURLY.names)


def training_features(
    hourly: DataFrame,
    dates: DataFrame,
    times: DataFrame,
    stores: DataFrame,
    cities: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """The hourly fact with all dimension attributes; the target is null while out of stock."""
    calendar = dates.select("date_key", "full_date", "day_of_week", "is_weekend", "holiday_flag")
    clock = times.select("time_key", "hour_of_day", "is_business_hour_6_22")
    places = stores.join(cities, "city_key").drop("city_key")
    available = ~F.col("stockout_flag")
    return (
        hourly.join(F.broadcast(calendar), "date_key")
        .join(F.broadcast(clock), "time_key")
        .join(places, "store_key")
        .join(products, "product_key")
        .withColumn("is_trainable_demand_observation", available)
        .withColumn("target_observed_sales_amount", F.when(available, F.col("observed_sales_amount")))
        .select(*S.FEATURE.names)
    )


def daily_with_places(
    daily: DataFrame, dates: DataFrame, stores: DataFrame, cities: DataFrame, products: DataFrame
) -> DataFrame:
    """The daily fact with date, place and product attributes."""
    places = stores.join(cities, "city_key").drop("city_key")
    return (
        daily.join(F.broadcast(dates.select("date_key", "full_date")), "date_key")
        .join(places, "store_key")
        .join(products, "product_key")
    )
