"""Exports and imports: feature files, prediction files, metric sidecars and queue CSV."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType

from restock import schema as S
from restock.functions.hashing import hash_unit
from restock.operators.ordering import first_rows

FEATURE_ORDER = ["date_key", "source_split", "store_key", "product_key", "time_key"]
COMPRESSIONS = ("zstd", "snappy", "gzip", "brotli", "none")


def feature_scan(
    features: DataFrame,
    split: str | None = None,
    start: date | None = None,
    end: date | None = None,
    first_category_id: int | None = None,
    store_id: int | None = None,
    product_id: int | None = None,
    trainable_only: bool = False,
    sample_rate: float | None = None,
    seed: int = 42,
    limit: int | None = None,
    ordered: bool | None = None,
) -> DataFrame:
    """Rows of the feature view that meet all given conditions, optionally ordered and limited.

    Without a word on it, rows are ordered where a limit makes the order matter. Date conditions are put on the date key too, so they prune partitions of the hourly fact.
    """
    if limit is not None and limit <= 0:
        raise ValueError("the row limit must be greater than zero")
    conditions: list[Column] = []
    for bound, compare in ((start, "ge"), (end, "le")):
        if bound is not None:
            key = int(bound.strftime("%Y%m%d"))
            for name, value in (("full_date", F.lit(bound)), ("date_key", F.lit(key))):
                conditions.append(F.col(name) >= value if compare == "ge" else F.col(name) <= value)
    equal = {
        "source_split": split,
        "first_category_id": first_category_id,
        "store_id": store_id,
        "product_id": product_id,
    }
    conditions += [F.col(name) == value for name, value in equal.items() if value is not None]
    if trainable_only:
        conditions.append(F.col("is_trainable_demand_observation"))
    if sample_rate is not None:
        if not 0 < sample_rate <= 1:
            raise ValueError("the sample rate must be in the range (0, 1]")
        conditions.append(hash_unit(seed, S.HOURLY_KEY) < sample_rate)
    rows = features
    for condition in conditions:
        rows = rows.filter(condition)
    if limit is not None:
        return rows.limit(limit) if ordered is False else first_rows(rows, FEATURE_ORDER, limit)
    return rows.orderBy(*FEATURE_ORDER) if ordered else rows


def normalise_features(features: DataFrame) -> DataFrame:
    """The feature file layout: missing whole numbers become 0, flags become booleans."""

    def column(field) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, (IntegerType, LongType)):
            return F.coalesce(value.try_cast(field.dataType), F.lit(0).cast(field.dataType))
        if isinstance(field.dataType, BooleanType):
            return F.coalesce(value.cast("boolean"), F.lit(False))
        return value.try_cast(field.dataType)

    return features.select(*[column(field).alias(field.name) for field in S.FEATURE])


def export_features(features: DataFrame, path: str, compression: str = "zstd") -> DataFrame:
    """Write the feature file and return it as read back; no rows is an error and leaves an older file alone."""
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression is one of {COMPRESSIONS}")
    if features.isEmpty():
        raise RuntimeError("no feature rows to export; are hourly facts loaded?")
    normalise_features(features).write.mode("overwrite").option("compression", compression).parquet(path)
    return features.sparkSession.read.schema(S.FEATURE).parquet(path)


def export_predictions(clamped: DataFrame, path: str) -> DataFrame:
    """Write clamped predictions in the prediction file layout."""
    clamped.select(*S.PREDICTION.names).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return clamped.sparkSession.read.parquet(path)


def write_document(document: DataFrame, path: str) -> None:
    """Write a one-row table of JSON text."""
    document.select("value").write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> DataFrame | None:
    """JSON documents as text, each file one row; None when the path does not exist."""
    try:
        return spark.read.option("wholetext", True).text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def sidecar_path(predictions_path: str, suffix: str) -> str:
    """``x_predictions.parquet`` has its sidecars at ``x_metrics.json`` and ``x_metadata.json``."""
    return predictions_path.replace("_predictions.parquet", suffix)


def export_queue(queue: DataFrame, path: str) -> DataFrame:
    """Write a queue as CSV with a header and return it as read back."""
    queue.write.mode("overwrite").option("header", True).csv(path)
    return queue.sparkSession.read.schema(queue.schema).option("header", True).csv(path)
