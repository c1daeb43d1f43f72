"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restock import schema as S
from restock.functions.hours import day_part, is_business_hour
from restock.operators.ordering import numbered


def dim_date(obs: DataFrame) -> DataFrame:
    """One row per observed date. Days and weeks follow ISO, the year is the calendar year."""
    dates = obs.groupBy(F.col("dt").alias("full_date")).agg(F.max("holiday_flag").alias("holiday_flag"))
    day = F.col("full_date")
    iso_day = F.weekday(day) + 1
    return dates.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day,
        iso_day.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter_number"),
        F.year(day).alias("year_number"),
        (iso_day >= 6).alias("is_weekend"),
        "holiday_flag",
    )


def dim_time(spark: SparkSession) -> DataFrame:
    hour = F.col("id").cast("int")
    return spark.range(S.HOURS_PER_DAY).select(
        hour.alias("time_key"),
        hour.alias("hour_of_day"),
        is_business_hour(hour).alias("is_business_hour_6_22"),
        day_part(hour).alias("day_part"),
    )


def dim_city(obs: DataFrame) -> DataFrame:
    return numbered(obs.select("city_id").distinct(), ["city_id"], "city_key")


def dim_store(obs: DataFrame, cities: DataFrame) -> DataFrame:
    stores = obs.select("store_id", "city_id").distinct()
    keyed = numbered(stores, ["store_id", "city_id"], "store_key")
    return keyed.join(cities, "city_id").select(*S.DIM_STORE.names)


def dim_product(obs: DataFrame) -> DataFrame:
    columns = ["product_id", *S.CATEGORY_LEVELS]
    return numbered(obs.select(*columns).distinct(), columns, "product_key")


def extend_dimension(existing: DataFrame, incoming: DataFrame, natural: list[str], key: str) -> DataFrame:
    """Add the incoming rows whose natural key is new, numbered after the highest key in use."""
    last = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("last")).scalar()
    attributes = [name for name in existing.columns if name != key]
    fresh = incoming.select(*attributes).join(existing.select(*natural), natural, "left_anti").distinct()
    keyed = numbered(fresh, natural, key).withColumn(key, F.col(key) + last)
    return existing.unionByName(keyed.select(*existing.columns))


def register_model(
    models: DataFrame, name: str, version: str, created_at, start=None, end=None
) -> DataFrame:
    """Register (name, version). A known pair keeps its key and gets the new stamp.

    Training dates of a known model are replaced when given and kept otherwise. Each argument is
    a value or a Column, for instance a scalar subquery.
    """

    def as_column(value, kind: str):
        return (value if hasattr(value, "cast") else F.lit(value)).cast(kind)

    stamp, first, final = as_column(created_at, "timestamp_ntz"), as_column(start, "date"), as_column(end, "date")
    same = (F.col("model_name") == name) & (F.col("model_version") == version)
    known = models.withColumns(
        {
            "training_start_date": F.when(same, F.coalesce(first, "training_start_date")).otherwise(
                F.col("training_start_date")
            ),
            "training_end_date": F.when(same, F.coalesce(final, "training_end_date")).otherwise(
                F.col("training_end_date")
            ),
            "created_at": F.when(same, stamp).otherwise(F.col("created_at")),
        }
    )
    status = models.agg(
        F.coalesce(F.max("model_key"), F.lit(0)).alias("last"), F.count_if(same).alias("known")
    ).filter(F.col("known") == 0)
    added = status.select(
        (F.col("last") + 1).alias("model_key"),
        F.lit(name).alias("model_name"),
        F.lit(version).alias("model_version"),
        first.alias("training_start_date"),
        final.alias("training_end_date"),
        stamp.alias("created_at"),
    )
    return known.unionByName(added)


def with_training_dates(models: DataFrame, estimates: DataFrame, dates: DataFrame, model_key: int) -> DataFrame:
    """Set one model's training range to the range of dates it has estimates for."""
    span = (
        estimates.filter(F.col("model_key") == model_key)
        .select("date_key")
        .distinct()
        .join(F.broadcast(dates.select("date_key", "full_date")), "date_key")
        .agg(F.struct(F.min("full_date").alias("first"), F.max("full_date").alias("last")).alias("span"))
        .scalar()
    )
    chosen = F.col("model_key") == model_key
    return (
        models.withColumn("_span", F.when(chosen, span))
        .withColumn("training_start_date", F.when(chosen, F.col("_span.first")).otherwise(F.col("training_start_date")))
        .withColumn("training_end_date", F.when(chosen, F.col("_span.last")).otherwise(F.col("training_end_date")))
        .drop("_span")
    )
