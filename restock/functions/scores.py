"""Daily scores, decisions and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from restock import schema as S


def stockout_rate(business_stockout_hours: Column) -> Column:
    return business_stockout_hours / F.lit(float(S.BUSINESS_HOURS))


def bias_rate(lost_sales: Column, demand: Column) -> Column:
    """Share of the demand that was lost."""
    return F.when(demand > 0, lost_sales / demand).otherwise(0.0)


def waste_risk(has_stockout: Column, sales: Column, usual_sales: Column) -> Column:
    """How far a day without any stockout fell below 1.25 times the product's usual sales."""
    shortfall = 1.0 - sales / (usual_sales * S.WASTE_SLACK)
    return (
        F.when(has_stockout, 0.0)
        .when(usual_sales > 0, clamp_unit(shortfall))
        .when(sales == 0, 1.0)
        .otherwise(0.0)
    )


def urgency_parts(rate: Column, bias: Column, activity: Column) -> tuple[Column, Column, Column]:
    return (
        rate * S.URGENCY_STOCKOUT_WEIGHT,
        bias * S.URGENCY_BIAS_WEIGHT,
        F.when(activity != 0, S.URGENCY_ACTIVITY_BONUS).otherwise(0.0),
    )


def urgency(rate: Column, bias: Column, activity: Column) -> Column:
    stockout, lost, bonus = urgency_parts(rate, bias, activity)
    return F.least(F.lit(1.0), stockout + lost + bonus)


def decision_action(urgency_score: Column, rate: Column, waste: Column, bias: Column) -> Column:
    """The first rule that holds names the action."""
    return (
        F.when(urgency_score >= S.URGENCY_THRESHOLD, S.RESTOCK)
        .when(rate >= S.STOCKOUT_RATE_THRESHOLD, S.INCREASE)
        .when(waste >= S.WASTE_THRESHOLD, S.REDUCE)
        .when(bias >= S.BIAS_THRESHOLD, S.REVIEW)
        .otherwise(S.MAINTAIN)
    )


def lookup(value: Column, table: dict[str, str]) -> Column:
    """Constant text per value; null where the table has none."""
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.element_at(F.create_map(*pairs), value)


def order_rank(value: Column, order: list[str], otherwise: int) -> Column:
    """Position of the value in a fixed order, from 1."""
    place = F.array_position(F.array(*[F.lit(item) for item in order]), value)
    return F.when(place > 0, place.cast("int")).otherwise(otherwise)


def clamp_unit(value: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))


def restock_priority(business_stockout_hours: Column) -> Column:
    return (
        F.when(business_stockout_hours >= 8, "critical")
        .when(business_stockout_hours >= 3, "high")
        .when(business_stockout_hours > 0, "watch")
        .otherwise("normal")
    )


def pressure_band(score: Column) -> Column:
    """Band of a category's urgency; a missing score counts as 0."""
    clamped = clamp_unit(F.coalesce(score, F.lit(0.0)))
    return F.when(clamped >= 0.65, "high").when(clamped >= 0.35, "medium").otherwise("low")


def hour_status(stockout: Column, lost_sales: Column, sales: Column) -> Column:
    return (
        F.when(stockout & (lost_sales > 0), "Stockout, demand recovered")
        .when(stockout, "Stockout observed")
        .when(sales > 0, "Observed sale")
        .otherwise("No sale observed")
    )


def hour_class(hour: Column, stockout: Column, lost_sales: Column) -> Column:
    return (
        F.when(stockout & hour.between(S.FIRST_BUSINESS_HOUR, S.LAST_BUSINESS_HOUR), "business_stockout")
        .when(stockout, "other_stockout")
        .when(lost_sales > 0, "recovered_loss")
        .otherwise("normal")
    )


def is_full_stockout(business_stockout_hours: Column, sales: Column) -> Column:
    """All business hours out of stock and nothing sold (missing values count as 0)."""
    return (F.coalesce(business_stockout_hours, F.lit(0)) >= S.BUSINESS_HOURS) & (
        F.coalesce(sales, F.lit(0.0)) <= 0
    )
