"""Model features of the hourly feature view.

Statistics come from the rows of one part only (``fit``), while every row receives them. Lags look
at the whole hourly timeline of a split, stockout hours included.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from restock import schema as S
from restock.operators.ordering import ordered_position
from restock.session import materialise, never_broadcast

if TYPE_CHECKING:
    from restock.operators.boundary import Boundary

FIT, CALIBRATION, EVAL = "fit", "calibration", "eval"
ROW_ORDER = ["full_date", "time_key", "store_id", "product_id"]


def demand_target(features: DataFrame, clip: bool = True) -> DataFrame:
    """The training target, or what was observed where there is none."""
    target = F.coalesce("target_observed_sales_amount", "observed_sales_amount").cast("double")
    return features.withColumn("demand_target", F.greatest(target, F.lit(0.0)) if clip else target)


def temporal_holdout(features: DataFrame, fraction: float = 0.15) -> DataFrame:
    """Add ``part``: eval for the eval split, calibration for the tail of the train dates, else fit.

    The tail is the last ceil(fraction * dates) dates, and leaves at least one date to fit. With a
    single train date it is the tail of the rows instead.
    """
    if fraction >= 1:
        raise ValueError("the calibration share must be less than 1")
    is_eval = F.col("source_split") == "eval"
    if fraction <= 0:
        return features.withColumn("part", F.when(is_eval, EVAL).otherwise(FIT))
    # The calendar is short, so it is fetched once and the cut is a literal for all later scans.
    dates = sorted(row.full_date for row in features.filter(~is_eval).select("full_date").distinct().collect())
    if len(dates) < 2:
        return _positional_holdout(features, fraction)
    tail = max(1, min(math.ceil(len(dates) * fraction), len(dates) - 1))
    in_tail = F.col("full_date") > F.lit(dates[-tail - 1])
    return features.withColumn("part", F.when(is_eval, EVAL).when(in_tail, CALIBRATION).otherwise(FIT))


def _positional_holdout(features: DataFrame, fraction: float) -> DataFrame:
    train = ordered_position(features.filter(F.col("source_split") != "eval"), ROW_ORDER, "_position")
    rows = train.agg(F.count(F.lit(1))).scalar()
    cut = F.greatest(F.lit(1), F.least(F.floor(rows * F.lit(1 - fraction)), rows - 1))
    placed = train.withColumn("part", F.when(F.col("_position") >= cut, CALIBRATION).otherwise(FIT))
    evaluation = features.filter(F.col("source_split") == "eval").withColumn("part", F.lit(EVAL))
    return placed.drop("_position").unionByName(evaluation)


def cyclic_time(features: DataFrame) -> DataFrame:
    def angle(name: str, period: float) -> Column:
        return F.col(name).cast("double") * (2 * math.pi) / F.lit(period)

    hour, weekday = angle("hour_of_day", 24.0), angle("day_of_week", 7.0)
    waves = {"hour_sin": F.sin(hour), "hour_cos": F.cos(hour), "dow_sin": F.sin(weekday), "dow_cos": F.cos(weekday)}
    return features.withColumns(waves)


def promo_weather(features: DataFrame) -> DataFrame:
    depth = F.greatest(1.0 - F.coalesce("discount_rate", F.lit(1.0)), F.lit(0.0))
    reduced = depth > 0.001
    heat = F.coalesce("avg_temperature", F.lit(0.0)) * F.coalesce("avg_humidity", F.lit(0.0)) / 100.0
    return features.withColumns(
        {
            "discount_depth": depth,
            "is_discounted": reduced,
            "is_promo_or_discount": reduced | (F.coalesce("activity_flag", F.lit(0)) != 0),
            "temperature_humidity_index": heat,
        }
    )


# Rows of a pair lie in one partition, sorted by pair, from the lags on, so the priors are joined where they lie.
_PAIR = ["store_id", "product_id"]


def _series():
    """A pair's hours in order. The grain is unique, so a series is at most 24 rows per calendar day."""
    return Window.partitionBy(*_PAIR, "source_split").orderBy("date_key", "time_key")


def hours_since_epoch(day: Column, hour: Column) -> Column:
    return F.unix_date(day) * S.HOURS_PER_DAY + hour


def sale_hour() -> Column:
    """The hour, counted since 1970, if something was sold in it."""
    clock = hours_since_epoch(F.col("full_date"), F.col("hour_of_day"))
    return F.when(F.coalesce("observed_sales_amount", F.lit(0.0)) > 0, clock)


def _days_since(last_sale: Column) -> Column:
    clock = hours_since_epoch(F.col("full_date"), F.col("hour_of_day"))
    return F.coalesce((clock - last_sale) / F.lit(float(S.HOURS_PER_DAY)), F.lit(-1.0))


def lag_one(features: DataFrame) -> DataFrame:
    previous = F.lag("observed_sales_amount", 1).over(_series())
    return features.withColumn("product_sales_lag_1h", F.coalesce(previous, F.lit(0.0)))


def rolling_sum(features: DataFrame, rows: int = 24) -> DataFrame:
    earlier = F.sum("observed_sales_amount").over(_series().rowsBetween(-rows, -1))
    return features.withColumn(f"product_sales_lag_{rows}h_sum", F.coalesce(earlier, F.lit(0.0)))


def days_since_previous_sale(features: DataFrame, sold_before: Column | None = None) -> DataFrame:
    """Days since the last sale before this hour; -1 when there was none.

    ``sold_before`` gives the hour of a sale that stands for the rows before the first one.
    """
    before = _series().rowsBetween(Window.unboundedPreceding, -1)
    sold = sale_hour() if sold_before is None else F.coalesce(sale_hour(), sold_before)
    return features.withColumn("days_since_previous_sale", _days_since(F.last(sold, True).over(before)))


def days_since_last_sale(features: DataFrame) -> DataFrame:
    """Days since the last sale up to and including this hour."""
    so_far = _series().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return features.withColumn("days_since_last_sale", _days_since(F.last(sale_hour(), True).over(so_far)))


def lags(features: DataFrame, sold_before: Column | None = None) -> DataFrame:
    """The three pair-level features over one shared sort."""
    return days_since_previous_sale(rolling_sum(lag_one(features.repartition(*_PAIR))), sold_before)


def sales_per_hour(features: DataFrame, owner: str) -> DataFrame:
    """Sales per owner and hour: one row per 24th of a calendar day."""
    return features.groupBy("source_split", owner, "date_key", "time_key").agg(
        F.sum("observed_sales_amount").alias("_sales")
    )


_STORE_HOUR = ["source_split", "store_id", "date_key", "time_key"]
_CATEGORY_HOUR = ["source_split", "first_category_id", "date_key", "time_key"]


def store_history(features: DataFrame, per_hour: DataFrame | None = None) -> DataFrame:
    """The store's sales in its previous hour, 0 before the first: one row per store and hour."""
    order = Window.partitionBy("source_split", "store_id").orderBy("date_key", "time_key")
    traffic = F.coalesce(F.lag("_sales", 1).over(order), F.lit(0.0))
    sums = sales_per_hour(features, "store_id") if per_hour is None else per_hour
    return sums.select(*_STORE_HOUR, traffic.alias("store_traffic_lag_1h"))


def category_history(features: DataFrame, rows: int = 24, per_hour: DataFrame | None = None) -> DataFrame:
    """The category's sales over its 24 hours before this one: one row per category and hour."""
    order = Window.partitionBy("source_split", "first_category_id").orderBy("date_key", "time_key")
    momentum = F.coalesce(F.sum("_sales").over(order.rowsBetween(-rows, -1)), F.lit(0.0))
    sums = sales_per_hour(features, "first_category_id") if per_hour is None else per_hour
    return sums.select(*_CATEGORY_HOUR, momentum.alias(f"category_momentum_{rows}h"))


# A history of up to this many rows (some 100 bytes each) is sent to every task, or of a fifth as many with the hours
# of a day in one row (some 500 bytes each); a longer one is shuffled.
HISTORY_ROWS = 1_000_000
_DAYS_SHARE = 5


def _is_short(stored: DataFrame, most: int) -> bool:
    return stored.limit(most + 1).count() <= most


def nested(table: DataFrame, keys: list[str], inner: list[str], name: str) -> DataFrame:
    """One row per ``keys`` with a map from ``inner`` to the other columns. Rows without a part of ``inner`` are left out."""
    values = [column for column in table.columns if column not in (*keys, *inner)]
    entry = F.struct(F.struct(*inner).alias("key"), F.struct(*values).alias("value"))
    known = reduce(lambda a, b: a & b, [F.col(column).isNotNull() for column in inner])
    return table.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.when(known, entry))).alias(name))


def unnested(rows: DataFrame, inner: list[str], name: str, values: list[str]) -> DataFrame:
    """The values of each row's own entry in place of the map, null if there is none."""
    found = rows.withColumn(name, F.try_element_at(F.col(name), F.struct(*inner)))
    return found.withColumns({value: F.col(name)[value] for value in values}).drop(name)


def join_history(rows: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """Join one row per owner and hour to the wide hourly rows; the last key is the hour of the day.

    A category can hold a quarter of an hour's rows, so the rows stay where they are as long as the
    written history is known to be small.
    """
    stored = materialise(history)
    if _is_short(stored, HISTORY_ROWS):
        return rows.join(F.broadcast(stored), keys, "left")
    days = materialise(nested(stored, keys[:-1], keys[-1:], "_hours"))
    if _is_short(days, HISTORY_ROWS // _DAYS_SHARE):
        values = [name for name in stored.columns if name not in keys]
        return unnested(rows.join(F.broadcast(days), keys[:-1], "left"), keys[-1:], "_hours", values)
    return rows.join(never_broadcast(stored), keys, "left")


def store_traffic(features: DataFrame) -> DataFrame:
    return join_history(features, store_history(features), _STORE_HOUR)


def category_momentum(features: DataFrame) -> DataFrame:
    return join_history(features, category_history(features), _CATEGORY_HOUR)


# Cells from which every prior is rolled up.
_CELL = ["store_id", "product_id", "first_category_id", "hour_of_day", "day_of_week"]


def _cells(features: DataFrame) -> DataFrame:
    """Sums and counts of the fit rows for every combination that occurs in any row.

    Written once: every prior is rolled up from this table, so the features are scanned once for
    all of them, and the joins are planned with its real size.
    """
    return materialise(features.groupBy(*_CELL).agg(*_cell_sums()))


def _cell_sums() -> list[Column]:
    fit = F.col("part") == FIT
    sold = F.when(fit & F.col("is_trainable_demand_observation"), F.col("observed_sales_amount"))
    flagged = F.when(fit, F.col("stockout_flag").cast("int"))
    return [
        F.sum(sold).alias("_sum"),
        F.count(sold).alias("_count"),
        F.sum(flagged).alias("_flagged"),
        F.count(flagged).alias("_rows"),
    ]


def grouped_once(rows: DataFrame, sets: list[list[str]], sums: list[Column]) -> list[DataFrame]:
    """The same sums by several groupings, from one scan: a written table, read once per grouping."""
    keys = list(dict.fromkeys(key for names in sets for key in names))
    grouped = rows.groupingSets([[F.col(name) for name in names] for names in sets], *keys)
    stored = materialise(grouped.agg(F.grouping_id().alias("_set"), *sums))
    values = [name for name in stored.columns if name not in (*keys, "_set")]
    # A bit, from the first key down, is set for every key that a grouping leaves out.
    numbers = [sum((key not in names) << place for place, key in enumerate(reversed(keys))) for names in sets]
    return [stored.filter(F.col("_set") == n).select(*names, *values) for n, names in zip(numbers, sets, strict=True)]


def _mean_table(cells: DataFrame, group: str, keys: list[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(
        F.try_divide(F.sum("_sum"), F.sum("_count")).alias(f"{group}_mean"),
        F.log1p(F.sum("_count").cast("double")).alias(f"{group}_count_log1p"),
    )


def _rate_table(cells: DataFrame, group: str, keys: list[str]) -> DataFrame:
    rate = F.try_divide(F.sum("_flagged"), F.sum("_rows"))
    return cells.groupBy(*keys).agg(rate.alias(f"{group}_stockout_rate"))


def _anchor(cells: DataFrame, tables: list[tuple[list[str], DataFrame]], time_key: str) -> tuple[DataFrame, list[str]]:
    """Roll-ups joined to the keys of one time column, and these keys beside the pair."""
    others = sorted({key for names, _ in tables for key in names} - {*_PAIR, time_key})
    inner = [*others, time_key] if any(time_key in names for names, _ in tables) else others
    anchor = cells.select(*_PAIR, *inner).distinct()
    for names, table in tables:
        # Tables by store grow with the facts; the others have a row per product or category at most.
        anchor = anchor.join(never_broadcast(table) if "store_id" in names else table, names, "left")
    return anchor, inner


def _priors(features: DataFrame, cells: DataFrame, means: bool, rates: bool) -> DataFrame:
    """Roll-ups joined to the features.

    They meet a table of distinct keys first, then one row a pair with the values of its hours and weekdays, at most
    24 and 7 a category. So the features are shuffled by pair once for all groupings, or not at all after the lags.
    """
    by_hour, by_weekday = [], []
    if rates:
        by_hour += [(keys, _rate_table(cells, group, keys)) for group, keys in S.STOCKOUT_GROUPS.items()]
    if means:
        for group, keys in S.PRIOR_GROUPS.items():
            target = by_weekday if "day_of_week" in keys else by_hour
            target.append((keys, _mean_table(cells, group, keys)))
    pairs, added = None, []
    for tables, time_key in ((by_hour, "hour_of_day"), (by_weekday, "day_of_week")):
        if tables:
            anchor, inner = _anchor(cells, tables, time_key)
            values = [name for name in anchor.columns if name not in (*_PAIR, *inner)]
            maps = nested(anchor, _PAIR, inner, f"_by_{time_key}")
            pairs = maps if pairs is None else pairs.join(never_broadcast(maps), _PAIR)
            added.append((inner, f"_by_{time_key}", values))
    rows = features.join(never_broadcast(materialise(pairs)), _PAIR, "left")
    return reduce(lambda found, part: unnested(found, *part), added, rows)


def demand_priors(features: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Mean demand and log count of ten groupings of the trainable fit rows.

    ``cells`` are their sums where they are stored already (``hour_sums.fit_cells``).
    """
    return _priors(features, _cells(features) if cells is None else materialise(cells), means=True, rates=False)


def stockout_priors(features: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Share of stockout hours of three groupings, over all fit rows."""
    return _priors(features, _cells(features) if cells is None else materialise(cells), means=False, rates=True)


def baseline_prior(with_priors: DataFrame) -> DataFrame:
    """The first mean that exists, else the mean of all trainable fit rows, else 0."""
    return _with_baseline(with_priors, _overall_mean(with_priors))


def _overall_mean(rows: DataFrame) -> Column:
    usable = (F.col("part") == FIT) & F.col("is_trainable_demand_observation")
    return rows.filter(usable).agg(F.avg("observed_sales_amount")).scalar()


def _with_baseline(with_priors: DataFrame, overall: Column) -> DataFrame:
    means = [F.col(f"{group}_mean") for group in S.PRIOR_GROUPS]
    return with_priors.withColumn("baseline_demand_prior", F.coalesce(*means, overall, F.lit(0.0)))


def numbers(features: DataFrame, columns: list[str]) -> dict[str, Column]:
    """All named columns as numbers without nulls; a column that is missing is 0."""
    kinds = dict(features.dtypes)

    def number(name: str) -> Column:
        if name not in kinds:
            return F.lit(0.0)
        value = F.col(name)
        if kinds[name] == "boolean":
            value = value.cast("int")
        return F.coalesce(value.cast("double"), F.lit(0.0))

    return {name: number(name) for name in columns}


def null_fill(features: DataFrame, columns: list[str]) -> DataFrame:
    """All named columns as numbers without nulls; a column that is missing becomes 0."""
    return features.withColumns(numbers(features, columns))


def feature_columns(advanced: bool = True) -> list[str]:
    return S.BASE_FEATURES + (S.ADVANCED_FEATURES if advanced else [])


def prepare_features(features: DataFrame, fraction: float = 0.15, advanced: bool = True) -> DataFrame:
    """All model features for the fit, calibration and eval parts, with statistics of the fit part."""
    parts = temporal_holdout(demand_target(features), fraction)
    if not advanced:
        return parts
    # All statistics come from one scan of the plain rows, so no step repeats the joins of another.
    cells, by_store, by_category = grouped_once(
        parts, [_CELL, _STORE_HOUR, _CATEGORY_HOUR], [*_cell_sums(), F.sum("observed_sales_amount").alias("_sales")]
    )
    return _enriched(parts, cells, by_store, by_category)


def _enriched(
    parts: DataFrame, cells: DataFrame, by_store: DataFrame, by_category: DataFrame, before: Boundary | None = None
) -> DataFrame:
    """All inputs from rows with their parts, sums of their hours and the cells that priors are rolled up from."""
    if before is not None:
        by_store, by_category = before.store_hours(by_store), before.category_hours(by_category)
    timed = promo_weather(cyclic_time(lags(parts) if before is None else before.lags(parts)))
    timed = join_history(timed, store_history(parts, by_store), _STORE_HOUR)
    timed = join_history(timed, category_history(parts, per_hour=by_category), _CATEGORY_HOUR)
    enriched = _priors(timed, cells, means=True, rates=True)
    overall = cells.agg(F.try_divide(F.sum("_sum"), F.sum("_count"))).scalar()
    # Flags stay what they are for the segments; the model reads them as numbers later.
    return _with_baseline(enriched, overall).fillna(0.0, _prior_columns())


def _prior_columns() -> list[str]:
    means = [f"{group}_mean" for group in S.PRIOR_GROUPS]
    return means + [f"{group}_count_log1p" for group in S.PRIOR_GROUPS] + S.STOCKOUT_FEATURES


@dataclass(frozen=True)
class Preparation:
    """What the features have learned from the fit part: sums and counts per cell, a table of its own.

    Stored beside a model it prepares rows of a new day without any train row. Priors, rates and
    the overall mean are all rolled up from the cells. Lags and histories look at the new rows alone,
    as they do per split, or also at the state that earlier dates of the split have left behind.
    """

    cells: DataFrame

    @classmethod
    def of(cls, prepared: DataFrame) -> Preparation:
        """The state behind rows that ``prepare_features`` gave."""
        return cls(prepared.filter(F.col("part") == FIT).groupBy(*_CELL).agg(*_cell_sums()))

    def save(self, path: str) -> None:
        self.cells.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/cells")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preparation:
        return cls(spark.read.parquet(f"{path}/cells"))

    def apply(self, features: DataFrame, part: str = EVAL, before: Boundary | None = None) -> DataFrame:
        """Rows of the hourly feature view with all inputs, as ``part``; equal to preparing them with the train rows.

        ``before`` is the state after the dates ahead of the given ones, if their splits go on.
        """
        rows = demand_target(features).withColumn("part", F.lit(part))
        sums = F.sum("observed_sales_amount").alias("_sales")
        new, by_store, by_category = grouped_once(rows, [_CELL, _STORE_HOUR, _CATEGORY_HOUR], [sums])
        # Cells that only the new rows reach count for no mean, but rows are joined through them.
        none = [F.lit(None).cast(kind).alias(name) for name, kind in self.cells.dtypes if name in ("_sum", "_flagged")]
        unknown = new.select(*_CELL, *none, F.lit(0).cast("long").alias("_count"), F.lit(0).cast("long").alias("_rows"))
        every = self.cells.unionByName(unknown).groupBy(*_CELL)
        cells = materialise(every.agg(*[F.sum(name).alias(name) for name in ("_sum", "_count", "_flagged", "_rows")]))
        return _enriched(rows, cells, by_store, by_category, before)
