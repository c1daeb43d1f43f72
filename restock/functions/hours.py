"""Expressions on the 24-hour arrays and on hours of the day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from restock.schema import BUSINESS_HOURS, FIRST_BUSINESS_HOUR, LAST_BUSINESS_HOUR


def array_total(values: Column, zero=0.0) -> Column:
    """Sum of an array; nulls inside count as nothing."""
    return F.aggregate(values, F.lit(zero), lambda total, x: total + F.coalesce(x, F.lit(zero)))


def business_slice(values: Column) -> Column:
    """The entries of hours 6..21 (array ordinals 7..22)."""
    return F.slice(values, FIRST_BUSINESS_HOUR + 1, BUSINESS_HOURS)


def is_business_hour(hour: Column) -> Column:
    return hour.between(FIRST_BUSINESS_HOUR, LAST_BUSINESS_HOUR)


def day_part(hour: Column) -> Column:
    return (
        F.when(hour.between(5, 10), "morning")
        .when(hour.between(11, 16), "afternoon")
        .when(hour.between(17, 21), "evening")
        .otherwise("night")
    )


def hour_ranges(hours: Column) -> Column:
    """Sorted distinct hours as text: ``6:00-9:00, 12:00``, or ``none`` for an empty list.

    A range starts at an hour whose predecessor is missing and ends at one whose successor is
    missing; both lists are in order, so they pair up by position.
    """
    starts = F.filter(hours, lambda h: ~F.array_contains(hours, h - 1))
    ends = F.filter(hours, lambda h: ~F.array_contains(hours, h + 1))
    labels = F.zip_with(
        starts,
        ends,
        lambda a, b: F.when(a == b, F.format_string("%d:00", a)).otherwise(
            F.format_string("%d:00-%d:00", a, b)
        ),
    )
    return F.when(F.size(hours) == 0, "none").otherwise(F.array_join(labels, ", "))


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)
