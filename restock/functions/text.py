"""Number formats of the published texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from restock.functions.scores import clamp_unit


def amount(value: Column) -> Column:
    """Two digits with thousands separators; missing is ``0``. Sums that end on a tie go up."""
    return F.when(value.isNull(), "0").otherwise(F.format_string("%,.2f", F.round(value + 1e-9, 2)))


def precise(value: Column, digits: int = 4) -> Column:
    return F.when(value.isNull(), "n/a").otherwise(F.format_string(f"%,.{digits}f", value))


def percent(value: Column, digits: int = 2) -> Column:
    return F.when(value.isNull(), "n/a").otherwise(F.format_string(f"%,.{digits}f%%", value * 100.0))


def percent_label(value: Column, digits: int = 0) -> Column:
    """Percentage of a score after clamping it to 0..1."""
    share = clamp_unit(F.coalesce(value, F.lit(0.0)))
    return F.format_string(f"%,.{digits}f%%", share * 100.0)
