"""Positions and running totals in a global order, without a single-task window.

Rows are range-partitioned by the order and written with their place to the shared folder, so the
cut points are drawn once and a lost executor cannot draw others. A row's position is its place in
its partition plus the size of all partitions before it; the only global step works on one row per
partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restock.session import materialise

# monotonically_increasing_id keeps the partition above bit 33 and the place in it below.
_PLACE_BITS = 33

# A top-n brings n rows of every task into one, so it is used up to this n only.
TOP_ROWS_LIMIT = 1_000


def _placed(df: DataFrame, order: list[Column]) -> DataFrame:
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(ranged.withColumn("_range_slot", F.monotonically_increasing_id()))
    return placed.withColumn("_range", F.shiftright("_range_slot", _PLACE_BITS))


def _offsets(placed: DataFrame, measure: Column) -> DataFrame:
    """Total of the measure over all earlier partitions: one row per partition."""
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_range").agg(measure.alias("_range_total"))
    before = F.coalesce(F.sum("_range_total").over(earlier), F.lit(0))
    return F.broadcast(totals.select("_range", before.alias("_range_before")))


def ordered_position(df: DataFrame, order: list, name: str = "position") -> DataFrame:
    """Add the 0-based position of every row; the order must be total."""
    placed = _placed(df, _columns(order))
    place = F.col("_range_slot").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.join(_offsets(placed, F.count(F.lit(1))), "_range")
        .withColumn(name, place + F.col("_range_before"))
        .drop("_range_slot", "_range", "_range_before")
    )


def running_total(df: DataFrame, order: list, value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over this and all earlier rows of the total order."""
    placed = _placed(df, _columns(order))
    inside = (
        Window.partitionBy("_range").orderBy("_range_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.join(_offsets(placed, F.sum(value)), "_range")
        .withColumn(name, F.sum(value).over(inside) + F.col("_range_before"))
        .drop("_range_slot", "_range", "_range_before")
    )


def first_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows of a total order; any n, since large ones never meet in one task.

    Beyond the limit for a top-n, a count per value of the leading column says up to which value
    rows can be among the first n. Only those are placed, and at the scan the rest is skipped.
    """
    if n <= TOP_ROWS_LIMIT:
        return df.orderBy(*_columns(order)).limit(n)
    rows = _up_to_cutoff(df, order[0], n) if isinstance(order[0], str) else df
    return ordered_position(rows, order, "_position").filter(F.col("_position") < n).drop("_position")


def _up_to_cutoff(df: DataFrame, leading: str, n: int) -> DataFrame:
    """Rows up to the last leading value that can matter; nulls come first in the order."""
    counts = df.groupBy(leading).agg(F.count(F.lit(1)).alias("_count"))
    reached = running_total(counts, [leading], "_count", "_reached").filter(F.col("_reached") >= n)
    first = F.min(F.struct(F.col(leading).isNotNull().alias("given"), F.col(leading).alias("value")))
    cutoff = reached.agg(first.alias("cutoff")).first().cutoff
    if cutoff is None:
        return df
    none = F.col(leading).isNull()
    return df.filter(none | (F.col(leading) <= F.lit(cutoff.value)) if cutoff.given else none)


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """Surrogate keys 1, 2, ... in the given order."""
    keyed = ordered_position(df, order, "_position")
    return keyed.select((F.col("_position") + 1).cast("int").alias(name), *df.columns)


def _columns(order: list) -> list[Column]:
    return [F.col(item) if isinstance(item, str) else item for item in order]
