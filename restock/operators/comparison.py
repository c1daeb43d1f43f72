"""The comparison flow: another feature schema, an imputed target and encoded inputs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from restock import schema as S
from restock.operators.features import grouped_once, join_history, nested, unnested
from restock.operators.ordering import ordered_position
from restock.session import materialise, never_broadcast


def comparison_hourly(obs: DataFrame) -> DataFrame:
    """Hourly rows in the comparison schema; fields the data lacks are constants.

    Weekdays count from Monday = 0 here.
    """
    hours = F.posexplode(F.arrays_zip("hours_sale", "hours_stock_status")).alias("hour", "cell")
    rows = obs.select(
        "source_split",
        "store_id",
        "product_id",
        F.col("city_id").alias("location"),
        F.col("first_category_id").alias("product_category"),
        F.col("second_category_id").alias("product_subcategory"),
        "discount",
        F.col("holiday_flag").alias("holiday"),
        F.col("activity_flag").alias("is_promotion"),
        "dt",
        hours,
    )
    zero = F.lit(0.0)
    return rows.withColumns(
        {
            "units_ordered": F.coalesce("cell.hours_sale", zero),
            "stockout_flag": F.coalesce("cell.hours_stock_status", F.lit(0)),
            "date": F.col("dt").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hour")),
            "day_of_week": F.weekday("dt"),
            "week_of_year": F.weekofyear("dt"),
            "month": F.month("dt"),
            "year": F.year("dt"),
            "stock_on_hand": zero,
            "selling_price": zero,
            "product_price": zero,
            "promotion_type": F.lit("missing"),
            "is_bulk_order": F.lit("missing"),
        }
    ).drop("cell")


def _clock() -> Column:
    return F.unix_date("dt") * S.HOURS_PER_DAY + F.col("hour")


# Rows of a pair lie in one partition from the context on; the baselines are joined where they lie.
_PAIR = ["store_id", "product_id"]


def comparison_context(hourly: DataFrame) -> DataFrame:
    """Days since the last sale, the store's previous hour and the category's last 24 hours."""
    series = Window.partitionBy(*_PAIR, "source_split").orderBy("dt", "hour")
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_sale = F.last(F.when(F.col("units_ordered") > 0, _clock()), True).over(so_far)
    rows = hourly.repartition(*_PAIR).withColumn(
        "days_since_last_sale", F.coalesce((_clock() - last_sale) / 24.0, F.lit(-1.0))
    )

    histories = {"store_id": ("store_traffic_lag_1h", -1), "product_category": ("category_momentum", -24)}
    keys = [["source_split", owner, "dt", "hour"] for owner in histories]
    totals = grouped_once(hourly, keys, [F.sum("units_ordered").alias("_units")])
    for own_keys, sums, (owner, (name, first)) in zip(keys, totals, histories.items(), strict=True):
        order = Window.partitionBy("source_split", owner).orderBy("dt", "hour").rowsBetween(first, -1)
        history = sums.withColumn(name, F.coalesce(F.sum("_units").over(order), F.lit(0.0)))
        rows = join_history(rows, history.drop("_units"), own_keys)
    return rows


BASELINES = {
    "store_product_hour_baseline": ["store_id", "product_id", "hour"],
    "product_hour_baseline": ["product_id", "hour"],
    "product_baseline": ["product_id"],
}


def comparison_baselines(hourly: DataFrame) -> DataFrame:
    """The train means of available hours for every (store, product, hour) that occurs in any split."""
    usable = (F.col("source_split") == "train") & (F.col("stockout_flag") == 0)
    sold = F.when(usable, F.col("units_ordered"))
    finest = BASELINES["store_product_hour_baseline"]
    cells = materialise(hourly.groupBy(*finest).agg(F.sum(sold).alias("_sum"), F.count(sold).alias("_count")))
    result = cells.withColumn("store_product_hour_baseline", F.try_divide("_sum", "_count"))
    for name, keys in BASELINES.items():
        if keys != finest:
            mean = cells.groupBy(*keys).agg(F.try_divide(F.sum("_sum"), F.sum("_count")).alias(name))
            result = result.join(mean, keys, "left")
    overall = cells.agg(F.coalesce(F.try_divide(F.sum("_sum"), F.sum("_count")), F.lit(0.0))).scalar()
    return result.withColumn("global_baseline", overall).drop("_sum", "_count")


def latent_target(hourly: DataFrame, mode: str = "latent_baseline") -> DataFrame:
    """``true_demand``: the baseline replaces lower sales of stockout hours, or plain observed sales."""
    observed = F.col("units_ordered")
    if mode == "observed":
        return hourly.withColumn("true_demand", F.greatest(observed, F.lit(0.0)))
    baseline = F.coalesce(*BASELINES, "global_baseline")
    latent = F.when(F.col("stockout_flag") == 1, F.greatest(observed, baseline)).otherwise(observed)
    of_pairs = nested(comparison_baselines(hourly), _PAIR, ["hour"], "_hours")
    joined = hourly.join(never_broadcast(of_pairs), _PAIR, "left")
    joined = unnested(joined, ["hour"], "_hours", [*BASELINES, "global_baseline"])
    return joined.withColumn("true_demand", F.greatest(latent, F.lit(0.0))).drop(*BASELINES, "global_baseline")


def comparison_clean(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Numbers as doubles without infinities, categories as text with ``missing`` for none."""
    absent = ["<NA>", "nan", "None"]

    def number(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)

    def text(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.when(value.isNull() | value.isin(absent), "missing").otherwise(value)

    others = [name for name in (keep or []) if name not in S.COMPARISON_NUMERIC + S.COMPARISON_CATEGORICAL]
    return df.select(
        *others,
        *[number(name).alias(name) for name in S.COMPARISON_NUMERIC],
        *[text(name).alias(name) for name in S.COMPARISON_CATEGORICAL],
    )


UNKNOWN_CODE = -2


def category_codes(clean_train: DataFrame, columns: list[str] = S.COMPARISON_CATEGORICAL) -> DataFrame:
    """(column_name, value, code): values of each column numbered from 0 in text order.

    The table is written, so each later join knows its real size: Spark broadcasts the small ones
    and shuffles a large one.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("value")) for name in columns])
    )
    distinct = clean_train.select(pairs.alias("p")).select("p.*").distinct()
    placed = ordered_position(distinct, ["column_name", "value"], "_position")
    first = placed.groupBy("column_name").agg(F.min("_position").alias("_first"))
    codes = placed.join(F.broadcast(first), "column_name")
    return materialise(codes.select("column_name", "value", (F.col("_position") - F.col("_first")).cast("int").alias("code")))


def numeric_scales(clean_train: DataFrame, columns: list[str] = S.COMPARISON_NUMERIC) -> DataFrame:
    """One row: mean and population deviation of each column, nulls taken as 0."""
    filled = {name: F.coalesce(name, F.lit(0.0)) for name in columns}
    measures = [
        F.struct(F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation")).alias(name)
        for name, value in filled.items()
    ]
    return clean_train.agg(*measures)


@dataclass(frozen=True)
class Encoding:
    """Codes of categories and scales of numbers, fitted on train rows; both are tables and can be stored."""

    codes: DataFrame
    scales: DataFrame

    @classmethod
    def fit(cls, clean_train: DataFrame) -> Encoding:
        return cls(category_codes(clean_train), numeric_scales(clean_train))

    def save(self, path: str) -> None:
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        self.scales.write.mode("overwrite").parquet(f"{path}/scales")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Encoding:
        return cls(spark.read.parquet(f"{path}/codes"), spark.read.parquet(f"{path}/scales"))

    def apply(self, clean: DataFrame) -> DataFrame:
        """Standardised numbers and ordinal codes; values that the train rows do not hold get -2."""
        scale = self.scales.select(F.struct(*S.COMPARISON_NUMERIC)).scalar()

        def standard(name: str) -> Column:
            centred = F.coalesce(name, F.lit(0.0)) - F.col(f"_scale.{name}.mean")
            spread = F.col(f"_scale.{name}.deviation")
            return centred / F.when(spread > 0, spread).otherwise(1.0)

        def coded(df: DataFrame, name: str) -> DataFrame:
            of_column = self.codes.filter(F.col("column_name") == name)
            table = of_column.select(F.col("value").alias(name), F.col("code").alias("_code"))
            return df.join(table, name, "left").withColumn(name, F.coalesce("_code", F.lit(UNKNOWN_CODE))).drop("_code")

        scaled = clean.withColumn("_scale", scale).withColumns({name: standard(name) for name in S.COMPARISON_NUMERIC})
        return reduce(coded, S.COMPARISON_CATEGORICAL, scaled.drop("_scale"))


def comparison_encode(clean: DataFrame, clean_train: DataFrame) -> DataFrame:
    """Standardised numbers and ordinal codes fitted on the train rows; unknown values get -2."""
    return Encoding.fit(clean_train).apply(clean)
