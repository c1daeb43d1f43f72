"""What lags and histories need of the hours before a date, so that later dates are computed without them.

Per store and product the last ``ROWS`` hours and the hour of the last sale, per store its last hour, per
category its last ``ROWS`` hours: tables that grow with the series, not with the history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from restock.operators import features as inputs
from restock.session import never_broadcast

ROWS = 24
PAIR = ["source_split", "store_id", "product_id"]
_HOUR = ["date_key", "time_key"]


def _last_rows(rows: DataFrame, owner: list[str], n: int) -> DataFrame:
    """The last ``n`` hours of every owner; Spark cuts the groups before it shuffles them."""
    newest = Window.partitionBy(*owner).orderBy(*[F.col(name).desc() for name in _HOUR])
    return rows.withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") <= n).drop("_place")


@dataclass(frozen=True)
class Boundary:
    """The state after some dates.

    ``hours``: the last hours of the pairs, with the hour of their last sale (null: none so far);
    ``stores`` and ``categories``: the last sums by owner and hour. Rows that come later must be of later dates.
    """

    hours: DataFrame
    stores: DataFrame
    categories: DataFrame

    @classmethod
    def of(cls, features: DataFrame) -> Boundary:
        """The state after all rows of the hourly feature view that are given."""
        rows = features.select(*PAIR, *_HOUR, "observed_sales_amount", inputs.sale_hour().alias("last_sale"))
        sums = [inputs.sales_per_hour(features, owner) for owner in ("store_id", "first_category_id")]
        return cls._last(rows, *sums)

    @classmethod
    def _last(cls, rows: DataFrame, by_store: DataFrame, by_category: DataFrame) -> Boundary:
        sales = rows.groupBy(*PAIR).agg(F.max("last_sale").alias("last_sale"))
        hours = _last_rows(rows.drop("last_sale"), PAIR, ROWS).join(never_broadcast(sales), PAIR)
        stores = _last_rows(by_store, ["source_split", "store_id"], 1)
        return cls(hours, stores, _last_rows(by_category, ["source_split", "first_category_id"], ROWS))

    def advance(self, features: DataFrame) -> Boundary:
        """The state after later rows as well; only they and the state are read."""
        rows = features.select(*PAIR, *_HOUR, "observed_sales_amount", inputs.sale_hour().alias("last_sale"))
        return self._last(
            self.hours.unionByName(rows),
            self.stores.unionByName(inputs.sales_per_hour(features, "store_id")),
            self.categories.unionByName(inputs.sales_per_hour(features, "first_category_id")),
        )

    def save(self, path: str) -> None:
        for name in ("hours", "stores", "categories"):
            getattr(self, name).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boundary:
        return cls(*(spark.read.parquet(f"{path}/{name}") for name in ("hours", "stores", "categories")))

    def lags(self, features: DataFrame) -> DataFrame:
        """The pair-level lags of new rows, as over their whole series."""
        new = features.withColumns({"_new": F.lit(True), "_sold_before": F.lit(None).cast("long")})
        known = self.hours.withColumnRenamed("last_sale", "_sold_before")
        lagged = inputs.lags(new.unionByName(known, allowMissingColumns=True), F.col("_sold_before"))
        return lagged.filter("_new").drop("_new", "_sold_before")

    def store_hours(self, per_hour: DataFrame) -> DataFrame:
        """Sums of a store's new hours behind those that are known."""
        return per_hour.unionByName(self.stores)

    def category_hours(self, per_hour: DataFrame) -> DataFrame:
        return per_hour.unionByName(self.categories)
