"""Retail observations derived from an event table, and model inputs on top of them.

The event table is the only given one with an hour of day over a short range of dates. Stores
come from users, products from the event properties, sales from event values and stockouts from error
events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock import schema as S
from restock.functions.hours import array_total, business_slice
from restock.session import never_broadcast

EVAL_START = "2024-01-24"
# Users with neighbouring ids share a store, so stores grow with the users and keep their ids.
USERS_PER_STORE = 15


def observations_from_events(events: DataFrame) -> DataFrame:
    """One row per (store, product) pair and calendar date, each with both 24-hour arrays."""
    sales = events.select(
        F.floor(F.col("user_id") / USERS_PER_STORE).cast("bigint").alias("store_id"),
        (F.get_json_object("props", "$.k").cast("bigint") % 20).alias("product_id"),
        F.col("ts").cast("date").alias("dt"),
        F.hour("ts").alias("hr"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        (F.col("event_type") == "error").cast("int").alias("error"),
    )
    hours = sales.groupBy("store_id", "product_id", "dt", "hr").agg(
        F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("sale"), F.max("error").alias("error")
    )
    # At most 24 entries per day.
    days = hours.groupBy("store_id", "product_id", "dt").agg(
        F.map_from_entries(F.collect_list(F.struct("hr", F.struct("sale", "error")))).alias("cells")
    )
    # Every pair gets every date of the calendar, whose length does not grow with the sales.
    dates = sales.agg(F.collect_set("dt").alias("dates")).scalar()
    grid = sales.select("store_id", "product_id").distinct().select("*", F.explode(dates).alias("dt"))
    panel = grid.join(never_broadcast(days), ["store_id", "product_id", "dt"], "left")

    clock = F.sequence(F.lit(0), F.lit(S.HOURS_PER_DAY - 1))
    day = F.dayofmonth("dt")
    outage = (F.col("store_id") * 7 + F.col("product_id") * 3 + day) % 23 == 0
    raw = F.transform(clock, lambda h: F.coalesce(F.col("cells")[h]["sale"], F.lit(0.0)))
    errors = F.transform(clock, lambda h: F.coalesce(F.col("cells")[h]["error"], F.lit(0)))
    arrays = panel.withColumn("raw", raw).withColumn("errors", errors)
    arrays = arrays.withColumn(
        "hours_sale", F.when(outage, F.transform("raw", lambda x: F.lit(0.0))).otherwise(F.col("raw"))
    ).withColumn(
        # An error takes the product off the shelf for its own hour and the next five.
        "hours_stock_status",
        F.transform(
            clock,
            lambda h: F.when(
                outage | F.exists(F.slice("errors", F.greatest(h - 4, F.lit(1)), F.least(h + 1, F.lit(6))), lambda e: e == 1),
                1,
            ).otherwise(0),
        ),
    )
    store, product = F.col("store_id"), F.col("product_id")
    return arrays.select(
        F.when(F.col("dt") >= F.lit(EVAL_START).cast("date"), "eval").otherwise("train").alias("source_split"),
        (store % 3).alias("city_id"),
        store.alias("store_id"),
        (product % 2).alias("management_group_id"),
        (product % 4).alias("first_category_id"),
        (product % 8 + 10).alias("second_category_id"),
        (product + 100).alias("third_category_id"),
        product.alias("product_id"),
        "dt",
        F.round(array_total(F.col("hours_sale")), 2).alias("sale_amount"),
        "hours_sale",
        array_total(business_slice(F.col("hours_stock_status")), 0).alias("stock_hour6_22_cnt"),
        "hours_stock_status",
        F.round(1 - 0.05 * ((store + product + day) % 5), 2).alias("discount"),
        day.isin(1, 15).cast("int").alias("holiday_flag"),
        ((product + day) % 6 == 0).cast("int").alias("activity_flag"),
        ((day * 7 + store % 3) % 10 / 2.0).alias("precpt"),
        (10 + day % 7 + store % 3).cast("double").alias("avg_temperature"),
        (60 + day % 20).cast("double").alias("avg_humidity"),
        (1 + day % 4 * 0.5).cast("double").alias("avg_wind_level"),
    )


def broken_observations(obs: DataFrame) -> DataFrame:
    """Observations in which every quality check fails for a known share of the rows."""
    case = (F.col("store_id") * 31 + F.col("product_id") + F.dayofmonth("dt")) % 97
    shortened = {
        name: F.when(case == 0, F.slice(name, 1, S.HOURS_PER_DAY - 1)).otherwise(F.col(name))
        for name in ("hours_sale", "hours_stock_status")
    }
    return (
        obs.withColumns(
            {
                **shortened,
                "stock_hour6_22_cnt": F.col("stock_hour6_22_cnt") + (case == 1).cast("int"),
                "sale_amount": F.col("sale_amount") + F.when(case == 2, 0.5).otherwise(0.0),
                "_copies": F.when(case == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))),
            }
        )
        .withColumn("_copy", F.explode("_copies"))
        .drop("_copies", "_copy")
    )


def conflicting_observations(obs: DataFrame) -> DataFrame:
    """Observations with a store in two cities, a product in two categories and keys in both splits."""
    late = F.col("dt") >= F.lit(EVAL_START).cast("date")
    moved = obs.withColumns(
        {
            "city_id": F.when((F.col("store_id") == 1) & late, F.col("city_id") + 1).otherwise(F.col("city_id")),
            "first_category_id": F.when(
                (F.col("product_id") == 3) & late, F.col("first_category_id") + 1
            ).otherwise(F.col("first_category_id")),
        }
    )
    twice = obs.filter((F.col("store_id") == 2) & (F.col("product_id") == 5) & late)
    return moved.unionByName(twice.withColumn("source_split", F.lit("train")))


def model_registry(dim_date: DataFrame, obs: DataFrame) -> DataFrame:
    """Three models over the training dates: the two oldest have predictions, the newest has none."""
    train = obs.filter(F.col("source_split") == "train").agg(
        F.min("dt").alias("training_start_date"), F.max("dt").alias("training_end_date")
    )
    models = F.explode(
        F.array(
            *[
                F.struct(F.lit(key).alias("model_key"), F.lit(f"demand_{key}").alias("model_name"))
                for key in (1, 2, 3)
            ]
        )
    )
    return train.select("*", models.alias("m")).select(
        "m.model_key",
        "m.model_name",
        F.lit("v1").alias("model_version"),
        "training_start_date",
        "training_end_date",
        F.date_add("training_end_date", F.col("m.model_key")).cast("timestamp_ntz").alias("created_at"),
    )


def predictions(features: DataFrame, model_key: int) -> DataFrame:
    """Predictions in the layout of a prediction file with only the required columns.

    Model 1 predicts a constant. Model 2 predicts 1.1 times the mean non-stockout training sale of
    the product and hour, and leaves out the first store.
    """
    columns = [*S.HOURLY_KEY, "source_split", "observed_sales_amount", "stockout_flag"]
    if model_key == 1:
        return features.select(*columns, F.lit(0.25).alias("predicted_demand"))
    usual = (
        features.filter((F.col("source_split") == "train") & ~F.col("stockout_flag"))
        .groupBy("product_key", "time_key")
        .agg(F.avg("observed_sales_amount").alias("_usual"))
    )
    return (
        features.filter(F.col("store_key") > 1)
        .join(usual, ["product_key", "time_key"], "left")
        .select(
            *columns, F.coalesce(F.round(F.col("_usual") * 1.1 + 1e-9, 6), F.lit(0.5)).alias("predicted_demand")
        )
    )
