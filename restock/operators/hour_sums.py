"""Sums of the hourly fact by period, from which averages and priors are rolled up.

A period is a run of ``PERIOD_DAYS`` days, so a stored table of these sums is a fraction of the fact,
and a reload replaces the periods of its dates only. By single dates it would be as long as the
fact itself: a store, product and hour has one row a date.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Four of every weekday: a cell of one store, product, hour and weekday sums up four rows of the fact.
PERIOD_DAYS = 28
KEYS = ["period", "source_split", "store_key", "product_key", "time_key", "day_of_week"]


def period_of(day: Column, days: int = PERIOD_DAYS) -> Column:
    return F.floor(F.unix_date(day) / days).cast("int")


def periods(dates: DataFrame, days: int = PERIOD_DAYS) -> dict[int, list[int]]:
    """The date keys of every period; the calendar is short."""
    rows = dates.select(period_of(F.col("full_date"), days).alias("period"), "date_key").collect()
    found: dict[int, list[int]] = {}
    for row in sorted(rows):
        found.setdefault(row.period, []).append(row.date_key)
    return found


def hour_sums(hourly: DataFrame, dates: DataFrame, extra: dict[str, Column] | None = None, days: int = PERIOD_DAYS) -> DataFrame:
    """Sums and counts of the sold amounts of hours on the shelf, and of stockout hours."""
    calendar = dates.select("date_key", "day_of_week", period_of(F.col("full_date"), days).alias("period"))
    placed = hourly.join(F.broadcast(calendar), "date_key").withColumns(extra or {})
    sold = F.when(~F.col("stockout_flag"), F.col("observed_sales_amount"))
    flagged = F.col("stockout_flag").cast("int")
    return placed.groupBy(*KEYS, *(extra or {})).agg(
        F.sum(sold).alias("sold_sum"),
        F.count(sold).alias("sold_count"),
        F.sum(flagged).alias("flagged"),
        F.count(flagged).alias("hours"),
    )


def fit_cells(
    sums: DataFrame,
    hourly: DataFrame,
    dates: DataFrame,
    times: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    last_fit: date,
    days: int = PERIOD_DAYS,
) -> DataFrame:
    """The cells behind the priors: train hours up to ``last_fit``, for every cell that occurs at all.

    Whole periods come from the stored sums; of the fact only the period is read that ``last_fit`` cuts.
    """
    calendar = periods(dates, days)
    cut = (last_fit - date(1970, 1, 1)).days // days
    last_key = int(last_fit.strftime("%Y%m%d"))
    edge = hourly.filter(F.col("date_key").isin(calendar.get(cut, [])))
    early = hour_sums(edge, dates, {"in_time": F.col("date_key") <= last_key}, days)
    whole = sums.filter(F.col("period") != cut).withColumn("in_time", F.col("period") < cut)
    fit = F.col("in_time") & (F.col("source_split") == "train")
    counted = lambda name: F.coalesce(F.sum(F.when(fit, F.col(name))), F.lit(0))
    return (
        whole.unionByName(early)
        .join(F.broadcast(times.select("time_key", "hour_of_day")), "time_key")
        .join(stores.select("store_key", "store_id"), "store_key")
        .join(products.select("product_key", "product_id", "first_category_id"), "product_key")
        .groupBy("store_id", "product_id", "first_category_id", "hour_of_day", "day_of_week")
        .agg(
            F.sum(F.when(fit, F.col("sold_sum"))).alias("_sum"),
            counted("sold_count").alias("_count"),
            F.sum(F.when(fit, F.col("flagged"))).alias("_flagged"),
            counted("hours").alias("_rows"),
        )
    )
